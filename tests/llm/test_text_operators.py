"""Text operators against brute force on small tables with every awkward row."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from starmill.llm import (
    language_id,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    pieces,
    sampling,
    suffix_dedup,
    toxicity,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, words string"
VOCABULARY = pieces.read_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def prose(seed: int, n: int = 60) -> str:
    draw = random.Random(seed)
    syllables = ["the", "an", "tion", "re", "wh", "st", "ou", "ing", "of", "nd"]
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty, blank and long texts, copies, near copies, repeated and nameless rows."""
    base = prose(1, 120)
    near = base.replace(base.split()[50], "changed", 1)
    rows = [
        (0, base), (1, base), (2, near), (3, None), (4, ""), (5, " \n\t "), (6, "one two"),
        (7, "one two"), (8, prose(2)), (8, prose(2)), (9, prose(3) + "\n" + base[:200]),
        (10, "é" * 40 + base[:120]), (11, prose(4, 4000)), (12, prose(4, 4000)[300:9000]),
        (None, prose(5)), (13, "The The The " * 30), (14, "12 34 !!"),
        *[(20 + i, base + " " + prose(40 + i, 3)) for i in range(6)],
    ]
    rows = [(i, t, "en" if i and i % 2 else None, "clash") for i, t in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).sortWithinPartitions("doc_id")


@pytest.fixture(scope="module")
def docs(spark, awkward, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    awkward.write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]


def test_packing_keeps_every_token_once_without_padding(docs, no_docs):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(TOKENIZER).encode
    rows = packing.pack_documents(docs, TOKENIZER).collect()
    ids = Counter(
        tuple([*encode(t.decode(), add_special_tokens=False).ids, 1]) for _, t in texts_of(docs)
    )
    assert sum(r.length for r in rows) == sum(len(k) * n for k, n in ids.items())
    whole = Counter(
        tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in rows if r.length == r.doc_tokens
    )
    assert not whole - ids
    sequences: dict[int, list] = {}
    for r in rows:
        assert len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    for pieces_ in sequences.values():
        at = 0
        for r in sorted(pieces_, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and (at & (at - 1) == 0)
    assert packing.pack_documents(no_docs, TOKENIZER).count() == 0


def test_the_level_minimises_the_squares():
    packer, draw = packing.Packer(16), random.Random(3)
    for i in range(300):
        size = draw.randint(1, 15)
        level = packer.level_for(size)

        def cost(h):
            counts = packer.counts.copy()
            counts[h] -= h > 0
            counts[h + size] += h + size < 16
            return int((counts[1:16] ** 2).sum())

        usable = [0, *(h for h in range(1, 17 - size) if packer.counts[h])]
        assert cost(level) == min(map(cost, usable))
        list(packer.add(packing.Piece(i, 0, np.zeros(size, np.uint32), size)))


def test_word_cache_equals_the_tokenizer():
    from tokenizers import Tokenizer

    tricky = ["Straße ΣΑΣ İ <|endoftext|>x DON'T we'll é é", "<|ENDOFTEXT|> a b 漢字 12\x01", ""]
    encode = Tokenizer.from_file(TOKENIZER).encode
    ours = packing.WordCache(TOKENIZER).encode([t.encode() for t in tricky])
    assert [o.tolist() for o in ours] == [encode(t, add_special_tokens=False).ids for t in tricky]


def test_word_cache_forgets_and_stays_right():
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(TOKENIZER).encode
    cache = packing.WordCache(TOKENIZER, limit=60)
    for seed in range(12):
        texts = [prose(90 + seed % 5, 30), "the End, of it", "", prose(200 + seed, 12)]
        ours = cache.encode([t.encode() for t in texts])
        assert [o.tolist() for o in ours] == [encode(t, add_special_tokens=False).ids for t in texts]


def brute_components(docs, words, percent):
    sets: dict = {}
    for doc_id, text in texts_of(docs):
        w = text.lower().split()
        grams = {tuple(w[i : i + words]) for i in range(len(w) - words + 1)}
        sets.setdefault(doc_id, []).append(frozenset(grams or ({tuple(w)} if w else set())))
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a is None or b is None or label[a] <= label[b]:
                    continue
                if any(s and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                    label[a], changed = label[b], True
    return sets, label


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_near_duplicates(docs, words, percent):
    sets, label = brute_components(docs, words, percent)
    for r in near_dedup.near_duplicates(docs, words, percent).collect():
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}
        assert r.component_id == (None if r.doc_id is None else label[r.doc_id])
        assert r.kept == (r.doc_id is None or r.doc_id == label[r.doc_id])


def test_sketches_merge_and_estimate():
    a, b = np.arange(900, dtype=np.uint64), np.arange(100, 1000, dtype=np.uint64)
    one, two, both = near_dedup.sketches([a, b, np.union1d(a, b)])
    assert (np.maximum(one, two) == both).all()
    n = np.array([900.0])
    assert abs(near_dedup.estimated_similarity(one[None], two[None], n, n)[0] - 0.8) < 0.15


def test_near_duplicates_of_no_documents(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_suffix_dedup(docs):
    texts = texts_of(docs)
    first: dict[bytes, int] = {}
    late = 2**63
    for doc_id, text in texts:
        for k in range(len(text) - 49):
            key = text[k : k + 50]
            first[key] = min(first.get(key, late), late if doc_id is None else doc_id)
    expected = Counter()
    for doc_id, text in texts:
        gone = bytearray(len(text))
        for k in range(len(text) - 49):
            if first[text[k : k + 50]] < (late if doc_id is None else doc_id):
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(text, gone) if not g)
        runs = len(bytes(gone).replace(b"\0", b" ").split())
        expected[doc_id, len(text), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    found = suffix_dedup.remove_repeated_passages(docs).collect()
    assert expected == Counter(
        (r.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest())
        for r in found
    )


def test_suffix_dedup_of_no_documents(no_docs):
    assert suffix_dedup.remove_repeated_passages(no_docs).count() == 0


@pytest.mark.parametrize("sizes", [(0, 1, 40, 7, 200), (3000, 0, 2500, 1, 4000), (1,), (5, 5)])
def test_merging_runs_is_sorting(sizes):
    from starmill.llm.runs import Runs, common_prefixes, encode_run, merged

    draw = np.random.default_rng(1)
    blobs, everything = [], []
    for n in sizes:
        rows = draw.integers(97, 99, (n, 12)).astype(np.uint8)
        rows = rows[np.lexsort(rows.T[::-1])]
        notes = np.column_stack([np.zeros(n, np.int64), len(everything) + np.arange(n)])
        blobs.append(encode_run(rows, notes, np.full((1, 1), len(blobs))))
        everything += [r.tobytes() for r in rows]
    runs = Runs(blobs)
    order, shared = merged(runs)
    rows = runs.rows[order]
    assert [r.tobytes() for r in rows] == sorted(everything)
    assert shared.tolist() == common_prefixes(rows).tolist()
    assert [everything[i] for i in runs.notes[0][order]] == sorted(everything)
    source = np.repeat(np.arange(len(sizes)), sizes)
    assert runs.table[runs.entry, 0].tolist() == source.tolist()


def test_loser_tree_shares_are_those_of_neighbours():
    from starmill.llm.runs import merge_heads

    lists = [[b"aab", b"abb", b"bbb"], [], [b"aaa", b"aab"], [b"bba"]]
    strings = [s for some in lists for s in some]
    cuts = np.cumsum([0] + [len(some) for some in lists]).tolist()
    prefixes = [0, 1, 0, 0, 2, 0]
    found = [(same, strings[place]) for same, place in merge_heads(strings, prefixes, cuts)]
    assert found == [(0, b"aaa"), (2, b"aab"), (3, b"aab"), (1, b"abb"), (0, b"bba"), (2, b"bbb")]


@pytest.mark.parametrize("by", ["line", "sentence", "paragraph"])
def test_units(docs, no_docs, by):
    seen, expected = {}, set()
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text)
    for doc_id, text in rows:
        for unit, (a, b) in enumerate(line_dedup.units_of(text, by)):
            words = tuple(line_dedup.normalised(text[a:b]))
            if words and seen.setdefault(words, (doc_id, unit)) != (doc_id, unit):
                expected.add((doc_id, unit, a, b, *seen[words]))
    assert expected
    assert {tuple(r) for r in line_dedup.repeated_units(docs, by).collect()} == expected
    assert line_dedup.repeated_units(no_docs, by).count() == 0


def test_sentences_tile_their_lines():
    draw = random.Random(9)
    for _ in range(300):
        text = "".join(draw.choices(["a", "bc ", "! ", ". ", ".", "\n", "。", "long words here "], k=60))
        lines = [text[a:b] for a, b in line_dedup.units_of(text, "line")]
        spans = list(line_dedup.units_of(text, "sentence"))
        assert "".join(text[a:b] for a, b in spans) == "".join(lines)
        for line in lines:
            a = sum(map(len, lines[: lines.index(line)])) + lines.index(line)
            own = [e - s for s, e in spans if a <= s and e <= a + len(line)]
            assert len(own) <= 1 or min(own) >= line_dedup.MIN_CHARS


def test_passages_are_caught_inside_lines_and_short_lines_whole(spark):
    passage = ". ".join(prose(70 + i, 9).capitalize() for i in range(7)) + ". "
    thai = "ภาษาไทยไม่มีช่องว่างระหว่างคำ"
    texts = [
        prose(80) + ". " + passage + prose(81),
        prose(82) + ". " + passage + prose(83) + "\nAll rights reserved\n" + thai,
        "all rights  reserved!\n" + thai + "\n" + thai.replace("ไ", "ใ") + "\nNo. Yes.\nNo. Yes.",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    gone = {}
    for r in line_dedup.repeated_units(df, "sentence").collect():
        gone[r.doc_id] = gone.get(r.doc_id, "") + texts[r.doc_id][r.start : r.end]
    assert sorted(gone) == [1, 2]
    # All but the end, which goes on differently, goes.
    assert len(gone[1]) >= len(passage) * 0.9 and gone[1] in passage
    assert len(gone[2]) == len("all rights  reserved!" + thai + "No. Yes.")


def test_language_of_every_row(docs, no_docs, spark):
    found = language_id.predict_languages(docs, language_id.learn(docs), ["words"]).collect()
    assert len(found) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in found:
        letters = any(c.isalpha() for c in texts[r.doc_id] or "")
        assert r.words == "clash" and 0 <= r.score <= 1
        assert r.lang_pred == ("en" if letters else "und")
    assert language_id.learn(no_docs) is None
    assert {r.lang_pred for r in language_id.predict_languages(docs, None).collect()} == {"und"}


def test_every_language_is_learned(spark):
    """More languages than may have all their documents: each keeps at least one."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"{letters[i % 26]}{letters[i // 26 % 4]}" * 30, f"l{i % 104:03}") for i in range(312)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language_id.learn(df, train_docs=3, train_total=50)
    assert trees.languages == sorted({lang for _, _, lang in rows})
    found = {r.doc_id: r.lang_pred for r in language_id.predict_languages(df, trees).collect()}
    assert found == {i: lang for i, _, lang in rows}


def test_code_lengths_are_those_of_partial_matching():
    import pandas as pd

    train, text = b"abracadabra abra", b"abrazabra"
    counts: dict = Counter()
    for order in range(4):
        for i in range(len(train) - order):
            counts[order, train[i : i + order + 1]] += 1
    frame = pd.DataFrame(
        [("x", o, int.from_bytes(g), n) for (o, g), n in counts.items()],
        columns=["lang", "context", "gram", "n"],
    )
    trees = language_id.ContextTrees.of(frame)
    trees.prepare()

    def bits(context: bytes, symbol: int) -> float:
        order = len(context)
        after = {g[-1]: n for (o, g), n in counts.items() if o == order and g[:-1] == context}
        total = sum(after.values())
        if symbol in after:
            return -math.log2(after[symbol] / (total + len(after)))
        escape = -math.log2(len(after) / (total + len(after))) if after else 0.0
        return escape + (bits(context[1:], symbol) if order else 8.0)

    exact = sum(bits(text[max(0, i - 3) : i], text[i]) for i in range(len(text)))
    data = np.frombuffer(text, np.uint8)
    assert trees.code_lengths(data, np.array([0, len(text)]))[0, 0] == pytest.approx(exact)


def test_lattice_marginals_sum_over_all_segmentations():
    index = {p: i for i, p in enumerate(VOCABULARY.pieces)}

    def total(x: bytes) -> float:
        if not x:
            return 1.0
        return sum(
            math.exp(VOCABULARY.log_probs[index[x[:n]]]) * total(x[n:])
            for n in range(1, len(x) + 1)
            if x[:n] in index
        )

    words = [b" the", b" thon", "é".encode(), b"\xff\x00"]
    ours = pieces.marginals(words, VOCABULARY.trie, VOCABULARY.log_probs[:, None])[:, 0]
    assert ours == pytest.approx([math.log(total(w)) for w in words])


def test_scores_of_awkward_documents(docs, no_docs):
    train = docs.where("doc_id is null or doc_id % 2 = 0")
    model, words = lm_scoring.train(train, VOCABULARY)
    counts = Counter(w for _, t in texts_of(train) for w in [*t.lower().split(), b""])
    total, kinds = sum(counts.values()), len(counts)
    for head in (5, 1000):
        found = lm_scoring.score_documents(docs, model, words, VOCABULARY, head).collect()
        by_text = Counter()
        for _, text in texts_of(docs):
            tokens = [*text.lower().split(), b""]
            base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
            by_text[len(tokens), sum(w in counts for w in tokens), round(base, 8)] += 1
        assert by_text == Counter((r.n_tokens, r.n_known, round(r.base_score, 8)) for r in found)
        assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    model, words = lm_scoring.train(no_docs, VOCABULARY)
    assert lm_scoring.score_documents(docs, model, words, VOCABULARY).count() == docs.count()


def test_very_long_words_are_scored_in_logs(docs):
    """A word of 10,000 bytes has the logarithm of its segmentations' sum, no floor."""
    model, _ = lm_scoring.train(docs, VOCABULARY)
    words = [b"x" * 5000, b"x" * 10_000, b"never seen"]
    found = model.scores(words, np.zeros((3, len(model.shares))), VOCABULARY.trie)
    spelled = pieces.marginals([b" " + w for w in words], VOCABULARY.trie, model.log_probs)
    exact = (spelled + np.log(model.discounts * model.kinds) - np.log(model.totals)) / np.log(10)
    assert np.allclose(found, exact) and (found[1] < 1.9 * found[0]).all() and (found[0] < -300).all()


def test_the_gradient_of_the_ordinal_fit_vanishes():
    draw = np.random.default_rng(5)
    rows = [np.flatnonzero(draw.random(6) < 0.4) for _ in range(300)]
    grades = np.array([min(2, int((r < 2).sum() + draw.integers(0, 2))) for r in rows])

    def loss(weights, bounds, l2=0.05):
        edges = np.concatenate([[-np.inf], bounds, [np.inf]])
        score = np.array([weights[r].sum() for r in rows])
        mass = toxicity._logistic(edges[grades + 1] - score) - toxicity._logistic(edges[grades] - score)
        return -np.log(mass).mean() + l2 / 2 * (weights**2).sum()

    weights, bounds = toxicity.fit_ordinal(rows, grades, 6, l2=0.05, steps=2000, rate=0.02)
    for i in range(6):
        step = np.eye(6)[i] * 1e-4
        slope = (loss(weights + step, bounds) - loss(weights - step, bounds)) / 2e-4
        assert abs(slope) < 2e-3
    for i in range(2):
        step = np.eye(2)[i] * 1e-4
        assert abs(loss(weights, bounds + step) - loss(weights, bounds - step)) / 2e-4 < 2e-3
    assert toxicity.choose_l2(rows, grades, 6) in toxicity.PENALTIES


def test_segmentations_are_distinct_and_spell_the_text(docs, no_docs):
    texts = {}
    for doc_id, text in texts_of(docs):
        texts.setdefault(doc_id, text)
    rows = sampling.sample_segmentations(docs.where("doc_id <> 8"), VOCABULARY, 3).collect()
    seen = Counter()
    for r in rows:
        assert sampling.decode_ids(r.ids, VOCABULARY) == texts[r.doc_id]
        assert 0 <= r.inclusion <= 1 and r.log_prob <= 1e-9
        assert math.isfinite(r.log_inclusion) and r.log_inclusion <= 0
        assert r.inclusion == pytest.approx(math.exp(r.log_inclusion), abs=1e-12)
        seen[r.doc_id, bytes(r.ids)] += 1
    assert set(seen.values()) == {1}
    assert Counter(r.doc_id for r in rows)[4] == 1
    assert sampling.sample_segmentations(no_docs, VOCABULARY).count() == 0


def test_samples_follow_the_distribution_without_replacement():
    sampler = sampling.Sampler(VOCABULARY)
    sampler.learn({b" a", b" in"})
    index = {p: i for i, p in enumerate(VOCABULARY.pieces)}
    ways = [((b" in",), ), ((b" i", b"n"), ), ((b" ", b"in"), ), ((b" ", b"i", b"n"), )]
    scores = np.array([sum(VOCABULARY.log_probs[index[p]] for p in w[0]) for w in ways])
    chance = np.exp(scores - np.logaddexp.reduce(scores))
    draws = sampler.sample([b" in"] * 4000, 4, [17 * i for i in range(4000)])
    first = Counter(tuple(VOCABULARY.pieces[i] for i in d[0][0]) for d in draws)
    for (way,), p in zip(ways, chance):
        assert first[way] / 4000 == pytest.approx(p, abs=0.03)
    assert all(len({tuple(x[0]) for x in d}) == 4 and d[0][3] == 1.0 for d in draws)


def test_forgetting_units_keeps_common_ones_and_changes_no_draw(monkeypatch):
    texts = [b" in a thing %d of it\n in  a" % i for i in range(60)]
    learned = Counter()
    plain = sampling.lattices
    whole = sampling.Sampler(VOCABULARY)
    whole.learn({u for t in texts for u in whole.units(t)})
    monkeypatch.setattr(sampling, "lattices", lambda units, trie: learned.update(units) or plain(units, trie))
    small = sampling.Sampler(VOCABULARY, limit=30)
    for i, text in enumerate(texts):
        units = small.units(text)
        small.learn(set(units))
        assert len(small._numbers) <= 30 and b"".join(units) == text
        (ours,), (theirs,) = (s.sample([text], 3, [i]) for s in (small, whole))
        for a, b in zip(ours, theirs, strict=True):
            assert a[0].tolist() == b[0].tolist() and a[1:] == pytest.approx(b[1:], abs=1e-9)
    assert learned[b" in"] == learned[b" a"] == learned[b"\n"] == 1
    assert sum(learned.values()) == len(learned)


def test_units_are_numbered_once_for_all_texts_of_a_call():
    class Counted(dict):
        asked = 0

        def __getitem__(self, unit):
            self.asked += 1
            return super().__getitem__(unit)

    sampler = sampling.Sampler(VOCABULARY)
    sampler.learn({b" in", b" a"})
    sampler._numbers = Counted(sampler._numbers)
    (found,), (again,) = sampler.sample([b" in a" * 500], 1, [5]), sampler.sample([b" in a" * 500], 1, [5])
    assert sampler._numbers.asked <= 4
    assert b"".join(VOCABULARY.pieces[i] for i in found[0][0]) == b" in a" * 500
    assert found[0][0].tolist() == again[0][0].tolist()


def test_units_end_where_words_and_lines_do():
    draw = random.Random(4)
    sampler = sampling.Sampler(VOCABULARY)
    whole = sampling.Sampler(pieces.Vocabulary.of([b"a", b"b", b" ", b"\n", b"a b"], range(5), np.zeros(5)))
    for _ in range(300):
        text = "".join(draw.choice("ab \n\t\u00e9") for _ in range(draw.randrange(12))).encode()
        assert sampler.units(text) == re.findall(rb"\n| *[^ \n]+| +", text)
        assert whole.units(text) == [text] * bool(text)
    units, cuts = sampler._cut([b"", b" a b", b"", b" c\n"])
    assert units.to_pylist() == [b" a", b" b", b" c", b"\n"] and cuts.tolist() == [0, 0, 2, 2, 4]
    assert sampler.sample([b"", b""], 3, [1, 2])[1][0][0].tolist() == []


def test_lattices_hold_every_arc_in_order_without_sorting_arcs(monkeypatch):
    draw = random.Random(5)
    words = ["".join(draw.choice(" ainthe\u4e00") for _ in range(draw.randrange(9))).encode() for _ in range(200)]
    words += [b"in" * 200, b""]
    number = {p: i for i, p in enumerate(VOCABULARY.pieces)}
    sorted_ = []
    plain = np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, *x, **y: sorted_.append(a.dtype.itemsize) or plain(a, *x, **y))
    lattice = pieces.lattices(words, VOCABULARY.trie)
    ahead = pieces.backward(lattice, VOCABULARY.log_probs[:, None])[:, 0]
    assert max(sorted_, default=0) <= 2  # positions in words, by radix
    monkeypatch.undo()
    expected, at = [], 0
    for word in words:
        for a in range(len(word)):
            for b in range(a + 1, len(word) + 1):
                if word[a:b] in number:
                    expected.append((-a, at + a, b - a, number[word[a:b]]))
        at += len(word) + 1
    expected.sort()
    ours = zip(lattice.start.tolist(), (lattice.end - lattice.start).tolist(), lattice.piece.tolist())
    assert list(ours) == [e[1:] for e in expected]
    reached = pieces.forward(lattice, VOCABULARY.log_probs[:, None])[:, 0]
    assert reached[lattice.last] == pytest.approx(ahead[lattice.first], abs=1e-9)


def test_what_samples_share_is_not_valued_again(monkeypatch):
    numbers, drawn = [], []
    plain, draw = sampling._at, sampling.Sampler._draw
    monkeypatch.setattr(sampling, "_at", lambda begun, places: numbers.append(len(places)) or plain(begun, places))

    def counted(self, *given):
        out = draw(self, *given)
        drawn.append(len(out[0]))
        return out

    monkeypatch.setattr(sampling.Sampler, "_draw", counted)
    sampler = sampling.Sampler(VOCABULARY)
    text = b" in a thing of it" * 200
    sampler.learn(set(sampler.units(text)))
    found = sampler.sample([text] * 20, 3, list(range(20)))
    assert all(len({tuple(f[0].tolist()) for f in some}) == 3 for some in found)
    # A number for every step drawn, one for every set that leaves it, a few for every text.
    assert sum(numbers) <= 2 * sum(drawn) + 20 * 10


def test_steps_release_what_others_left_before_they_begin(monkeypatch):
    from starmill.llm import common

    seen = []
    monkeypatch.setattr(common, "release_memory", lambda: seen.append("release"))
    assert list(common.releasing(lambda parts: (seen.append(p) or p for p in parts))(iter([1, 2]))) == [1, 2]
    assert seen == ["release", 1, 2, "release"]


def test_the_direct_pattern_needs_no_copy_of_the_whole_tokenizer():
    cache = packing.WordCache(TOKENIZER)
    inner = cache._tokenizer

    class Parts:
        normalizer, pre_tokenizer = inner.normalizer, inner.pre_tokenizer

    cache._tokenizer = Parts()
    assert cache._direct_pattern()("don't 12") == ["don", "'t", "1", "2"]


def test_ordinal_regression_and_severity(spark, no_docs):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        text = prose(i, 40) + (" idiot" * draw.randint(1, 6) + " scum" if toxic else "")
        rows.append((i, text, "en", "clash"))
        labels.append((i, int(toxic)) if i < 300 else (i, None))
    rows += [(900, None, None, None), (901, "", None, None), (902, prose(1, 3000), None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, known)
    assert (np.diff(model.thresholds) > 0).all()
    found = {r.doc_id: r for r in toxicity.score_severity(docs, model, ["words"]).collect()}
    assert all(found[i].toxic == (i % 4 == 0) for i in range(300, 400))
    assert all(0 <= r.severity <= 2 for r in found.values()) and found[1].words == "clash"
    assert not any(found[i].toxic for i in (900, 901, 902)) and found[900].severity == 0
    assert toxicity.train(no_docs, known) is None
    assert toxicity.score_severity(docs, None).where("toxic").count() == 0


def test_held_out_remainders_are_those_of_crc32(spark):
    from starmill.llm.common import id_remainder

    rows = spark.range(50).select("id", id_remainder(F.col("id"), 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in rows)
