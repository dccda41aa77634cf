"""Near-duplicate documents by SetSketch registers, bands and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import mix64, releasing, stored, utf8
from starmill.llm.components import components
from starmill.llm.shingles import set_digest, shingle_sets, similar, text_bytes

#: Registers of a sketch, a prime, so that every stride visits all of them; bands use
#: the first 100.
REGISTERS = 101
#: Chance that a pair at the threshold shares no band.
MISSED = 1e-5
#: Base of the exponential spacing of register values.
SPACING = 1.005
#: Pairs whose estimated similarity lies this far below the threshold, some six standard
#: errors of 101 registers, are not verified.
MARGIN = 0.22


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of every set, a row each; empty sets have zeros.

    Every element sends one exponentially distributed value to every register, in
    ascending order and along a stride of its own; a register keeps the smallest, as a
    whole number on an exponential scale. An element stops once its next value cannot be
    below any register's, which for large sets is after the first few. Registers of a
    union are the larger ones of its parts.
    """
    m = REGISTERS
    sizes = np.array([len(s) for s in sets])
    kept = np.full((len(sets), m), np.inf)
    if sizes.sum():
        owner = np.repeat(np.arange(len(sets)), sizes)
        element = np.concatenate(sets)
        start = (mix64(element, 21) % np.uint64(m)).astype(np.int64)
        stride = (mix64(element, 22) % np.uint64(m - 1)).astype(np.int64) + 1
        flat = kept.reshape(-1)
        for turn in range(m):
            u = (mix64(element, 100 + turn) >> np.uint64(11)).astype(float) * 2.0**-53
            value = -np.log1p(-np.minimum((turn + u) / m, 1 - 2.0**-53))
            np.minimum.at(flat, owner * m + (start + turn * stride) % m, value)
            # The next value is at least this; the doubtful registers are the largest.
            next_least = -np.log1p(-(turn + 1) / m) if turn + 1 < m else np.inf
            active = (kept.max(axis=1) > next_least)[owner]
            if not active.any():
                break
            owner, element, start, stride = (x[active] for x in (owner, element, start, stride))
    with np.errstate(divide="ignore"):
        level = np.floor(1.0 - np.log(kept) / np.log(SPACING)) + 10_000
    level[~np.isfinite(kept)] = 0
    return np.clip(level, 0, 65_535).astype(np.uint16)


def band_shape(percent: int) -> tuple[int, int]:
    """Bands and their registers: the longest bands that miss few enough pairs."""
    used = REGISTERS - 1
    fit = [r for r in range(1, used + 1) if (1 - (percent / 100) ** r) ** (used // r) <= MISSED]
    rows = max(fit, default=1)
    return used // rows, rows


def band_keys(registers: np.ndarray, percent: int) -> np.ndarray:
    """A key per band and row, equal for equal registers of the band."""
    bands, size = band_shape(percent)
    rows = registers[:, : bands * size].reshape(len(registers), bands, size)
    keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), rows.shape[:2])
    with np.errstate(over="ignore"):
        for i in range(size):
            keys = mix64(keys * np.uint64(65_537) + rows[:, :, i].astype(np.uint64), 31)
    return keys.astype(np.int64)


def estimated_similarity(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, steps: int = 40
) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sets from their registers and sizes.

    Registers above, below and equal to the partner's have probabilities that follow
    from the similarity; the log likelihood is concave in it and searched by thirds.
    """
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - above - below
    u = size_a / (size_a + size_b)
    v = 1.0 - u

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (SPACING - 1) / SPACING) / np.log(SPACING)

    def likelihood(j: np.ndarray) -> np.ndarray:
        p, q = chance(np.maximum(u - v * j, 0)), chance(np.maximum(v - u * j, 0))
        tiny = 1e-12
        rest = np.maximum(1 - p - q, tiny)
        return above * np.log(p + tiny) + below * np.log(q + tiny) + equal * np.log(rest)

    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(steps):
        third = (high - low) / 3
        left = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(left, low + third, low), np.where(left, high, high - third)
    return (low + high) / 2


_SKETCHED = "doc_id long, n_shingles long, digest_a long, digest_b long, registers binary"


def sketch_documents(docs: DataFrame, words: int) -> DataFrame:
    """Set size, 128-bit digest of the set and registers of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(*text_bytes(batch, "text"), words)
                digests = [set_digest(s) for s in sets]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": batch.column("doc_id"),
                        "n_shingles": np.array([len(s) for s in sets], np.int64),
                        "digest_a": np.array([d[0] for d in digests], np.int64),
                        "digest_b": np.array([d[1] for d in digests], np.int64),
                        "registers": [r.tobytes() for r in sketches(sets)],
                    }
                )

    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("text"))
    return rows.mapInArrow(releasing(sketch), _SKETCHED)


def _registers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _banded(classes: DataFrame, percent: int) -> DataFrame:
    """(band, id): a row per band of every class."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_registers(batch, "registers"), percent)
            ids = np.repeat(batch.column("id").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_pydict({"band": keys.ravel(), "id": ids})

    return classes.select("id", "registers").mapInArrow(releasing(split), "band long, id long")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose estimated similarity is not far below the threshold."""
    for side in ("a", "b"):
        facts = classes.select(
            F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("registers").alias(f"r_{side}")
        )
        pairs = pairs.join(facts, side)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                n = [batch.column(f"n_{s}").to_numpy().astype(float) for s in "ab"]
                j = estimated_similarity(_registers(batch, "r_a"), _registers(batch, "r_b"), *n)
                yield batch.select(["a", "b"]).filter(pa.array(j >= percent / 100 - MARGIN))

    ratio = F.lit(percent) * F.greatest("n_a", "n_b") <= 100 * F.least("n_a", "n_b")
    return (
        pairs.where(ratio)
        .select("a", "b", "n_a", "n_b", "r_a", "r_b")
        .mapInArrow(releasing(estimate), "a long, b long")
    )


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (a, b) that are similar on their full sets."""
    for side in ("a", "b"):
        held = texts.select(F.col("id").alias(side), F.col("text").alias(f"t_{side}"))
        pairs = pairs.hint("merge").join(held, side)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(*text_bytes(batch, "t_a"), words)
                good = []
                for ours, scalar in zip(sets, batch.column("t_b"), strict=True):
                    # Rows come in the order of b: a hub's set is made once.
                    text = scalar.as_py()
                    if text != last:
                        data = np.frombuffer(text, np.uint8)
                        last, held = text, shingle_sets(data, np.array([0, len(data)]), words)[0]
                    good.append(similar(ours, held, percent))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.select("a", "b", "t_a", "t_b").mapInArrow(releasing(verify), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked where the Jaccard similarity of their sets of distinct
    ``words``-word shingles reaches ``percent``; a component is what links connect.

    1. Rows of equal sets are one class, known by its smallest doc_id.
    2. Classes that agree in a band of their SetSketch registers are candidates. Two
       sets at the threshold share no band with a chance of 1 in 100,000 at most.
    3. In every band value all classes meet the hub only, the one that shares most bands
       with others; pairs that the registers' likelihood leaves possible are verified on
       the full sets. A group of n copies costs n pairs this way.
    4. Band values that still hold several families, classes not connected yet, are searched
       exactly. A class is known by its differences from what most classes under the hub
       have. Two that are linked share so many of these that they meet in the rarest, or
       have so few that both are linked with the class nearest to the consensus. Pairs
       that meet this way are verified.

    A null text or one without words has n_shingles 0 and is linked with nothing, a
    shorter text is one shingle. Rows that share a doc_id are one document with the
    links of any of them. A row without a doc_id takes no part: component_id is null,
    kept true. Empty tables give no rows; other columns are ignored.
    """
    sketched = stored(sketch_documents(docs, words), "set-sketches")
    real = sketched.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    digest = ["digest_a", "digest_b"]
    classes = stored(
        real.groupBy(*digest).agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        ),
        "shingle-classes",
    )
    shared = _bands(classes, percent)
    hubs = shared.select(F.col("id").alias("a"), F.col("hub").alias("b")).where("a != b").distinct()
    texts = _texts(docs, shared)
    links = stored(
        _verified(_likely(hubs, classes, percent), texts, words, percent), "verified-links"
    )
    families = stored(_connected(links), "families")
    rest = _rest(shared, families, texts, words, percent)
    more = _verified(_likely(rest, classes, percent), texts, words, percent)
    # Rows of one class, and those of one doc_id, belong together.
    members = classes.select("id", *digest).join(real.select("doc_id", *digest), digest)
    members = stored(members.select("doc_id", "id"), "class-members")
    component = _joined_families(families, more.union(_of_one_document(members)))
    found = members.join(component, "id", "left").withColumn("component", F.coalesce("component", "id"))
    found = found.where(F.col("component") < F.col("doc_id")).select("doc_id", "component").distinct()
    row = sketched.select("doc_id", "n_shingles")
    component = F.coalesce("component", "doc_id")
    return row.join(found, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _of_one_document(members: DataFrame) -> DataFrame:
    """Links (a, b) of the classes in which rows of one document are."""
    ends = members.groupBy("doc_id").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    several = members.join(ends.where("low < high"), "doc_id").where("id > low")
    return several.select(F.col("id").alias("a"), F.col("low").alias("b"))


def _joined_families(families: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component) of all classes in a component of several, by links of their families."""
    links = stored(links, "more-links")
    for side in ("a", "b"):
        own = families.select(F.col("id").alias(side), F.col("family").alias(f"family_{side}"))
        links = links.join(own, side, "left")
    joined = components(
        links.select(F.coalesce("family_a", "a").alias("a"), F.coalesce("family_b", "b").alias("b"))
    )
    alone = joined.join(families, "id", "left_anti").select("id", F.col("id").alias("family"))
    classes = families.union(alone)
    return classes.join(joined.withColumnRenamed("id", "family"), "family", "left").select(
        "id", F.coalesce("component", "family").alias("component")
    )


def _bands(classes: DataFrame, percent: int) -> DataFrame:
    """(band, id, hub) of the band values that several classes share. The hub is the
    class whose band values are shared most; ties take the smaller id."""
    rows = stored(_banded(classes, percent), "bands")
    sizes = rows.groupBy("band").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = stored(rows.join(stored(sizes, "band-sizes"), "band"), "shared-bands")
    weight = shared.groupBy("id").agg(F.sum("size").alias("weight"))
    weighted = stored(shared.select("band", "id").join(weight, "id"), "weighted-bands")
    best = F.max(F.struct("weight", (-F.col("id")).alias("id")))
    hub = weighted.groupBy("band").agg((-best.getField("id")).alias("hub"))
    joined = weighted.select("band", "id").join(stored(hub, "band-hubs"), "band")
    return stored(joined, "hubs")


def _texts(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """Texts of the classes that share a band value: all that may be verified."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), utf8().alias("text"))
    # Merged at every size: whether the ids could be broadcast depends on the input.
    wanted = shared.select("id").distinct().hint("merge")
    return stored(rows.join(wanted, "id", "left_semi"), "candidate-texts")


def _connected(links: DataFrame) -> DataFrame:
    """(id, family): what the links so far connect. Pairs of one family need no search."""
    return components(links).select("id", F.col("component").alias("family"))


_APART = "hub long, id long, family long, main long, best long, n long, n_hub long, apart array<long>"


def _apart_from_hub(contexts: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """Per class and hub: the sizes of both and the hashes that only one of them has."""
    for side, name in (("id", "t_a"), ("hub", "t_b")):
        held = texts.select(F.col("id").alias(side), F.col("text").alias(name))
        contexts = contexts.hint("merge").join(held, side)
    through = ["hub", "id", "family", "main", "best"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for whole in batches:
            for at in range(0, len(whole), 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(*text_bytes(batch, "t_a"), words)
                apart, hubs = [], []
                for ours, scalar in zip(sets, batch.column("t_b"), strict=True):
                    text = scalar.as_py()
                    if text != last:
                        data = np.frombuffer(text, np.uint8)
                        last, held = text, shingle_sets(data, np.array([0, len(data)]), words)[0]
                    apart.append(np.setxor1d(ours, held, assume_unique=True).astype(np.int64))
                    hubs.append(len(held))
                columns = {c: batch.column(c) for c in through}
                columns |= {"n": np.array([len(x) for x in sets], np.int64), "n_hub": np.array(hubs, np.int64)}
                columns["apart"] = pa.array(apart, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return contexts.select(*through, "t_a", "t_b").mapInArrow(releasing(compare), _APART)


def _around_consensus(rows: DataFrame, ratio: float) -> DataFrame:
    """The same differences around what most classes under the hub have instead.

    ``far`` is the number of differences less ``ratio`` shingles for each of the class:
    two classes are linked at most if they share half the sum of theirs, or more, of
    their differences.
    """
    tokens = rows.select("hub", F.explode("apart").alias("shingle"))
    often = tokens.groupBy("hub", "shingle").agg(F.count("*").alias("often"))
    sizes = rows.groupBy("hub").agg(F.count("*").alias("classes"))
    most = often.join(sizes, "hub").where(2 * F.col("often") > F.col("classes"))
    most = stored(most.groupBy("hub").agg(F.collect_list("shingle").alias("most")), "consensus")
    around = F.when(F.col("most").isNull(), F.col("apart")).otherwise(
        F.concat(F.array_except("apart", "most"), F.array_except("most", "apart"))
    )
    moved = rows.join(most, "hub", "left").withColumn("apart", around).drop("most")
    return stored(moved.withColumn("far", F.size("apart") - ratio * F.col("n")), "consensus-apart")


def _rare_prefixes(rows: DataFrame, percent: int) -> DataFrame:
    """Where classes under one hub may meet: (hub, shingle, low, high, id).

    Two sets that share ``need`` members also meet in the rarest ``size - need + 1`` of
    each. Rarity is that under the hub; differences of one family come first, bring no
    pair together and are left out. What is needed depends on both classes: ``far`` is
    cut into steps, and a class has a prefix for every step that a partner may be in.
    ``low`` and ``high`` are the steps of both.
    """
    t, r = percent / 100, _ratio(percent)
    place = ["hub", "shingle"]
    tokens = rows.select("hub", "family", "id", F.explode("apart").alias("shingle"))
    ends = tokens.groupBy(*place).agg(
        F.min("family").alias("first"), F.max("family").alias("last"), F.count("*").alias("often")
    )
    met = stored(ends.where(F.col("first") < F.col("last")).select(*place, "often"), "met-shingles")
    mine = Window.partitionBy("hub", "id")
    ranked = tokens.select("hub", "id", "shingle").join(met, place).withColumns(
        {"rank": F.row_number().over(mine.orderBy("often", "shingle")), "met": F.count("*").over(mine)}
    )
    n, far, size = F.col("n"), F.col("far"), F.size("apart")
    step = F.greatest(F.floor(r / 2 * F.col("n_hub")), F.lit(1))
    # Differences of linked classes differ in number by no more than the classes do.
    most = r * (n + n / t)
    lowest = F.greatest(-far, F.greatest(size - most, F.lit(0.0)) - r * n / t)
    highest = size + most - r * t * n
    measured = rows.select(
        "hub", "id", size.alias("size"), "far", step.alias("step"),
        F.floor(far / step).alias("own"), F.floor(lowest / step - 1e-6).alias("from"), F.floor(highest / step + 1e-6).alias("to"),
    ).where(F.col("from") <= F.col("to"))
    # A prefix with room for the rank: size - need + 1 >= rank + (size - met), with need
    # half of far and the partner's step, at least one.
    spare = F.col("met") - F.col("rank") + 1
    upto = F.floor((2 * spare - F.col("far")) / F.col("step") + 1e-6)
    reach = ranked.join(measured, ["hub", "id"]).where(spare >= 1)
    steps = F.when(F.least("to", upto) >= F.col("from"), F.sequence(F.col("from"), F.least("to", upto)))
    met_at = reach.select("hub", "shingle", "id", "own", F.explode(steps).alias("other"))
    return met_at.select(
        *place, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") <= F.col("other")).alias("lower"), (F.col("own") >= F.col("other")).alias("upper"), "id",
    )


def _ratio(percent: int) -> float:
    """Differences that linked sets may have for each shingle of both."""
    return (100 - percent) / (100 + percent)


def _rest(shared: DataFrame, families: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs of different families under one hub that may be similar."""
    labelled = shared.join(families, "id", "left").select(
        "band", "id", "hub", F.coalesce("family", "id").alias("family")
    )
    labelled = stored(labelled, "labelled-bands")
    # A band value of two classes is settled: one of them was the hub of the other.
    ends = labelled.groupBy("band").agg(
        F.min("family").alias("low"), F.max("family").alias("high"), F.count("*").alias("size")
    )
    open_bands = ends.where((F.col("low") < F.col("high")) & (F.col("size") > 2)).select("band")
    open_bands = stored(open_bands, "open-bands")
    contexts = (
        labelled.join(open_bands, "band")
        .groupBy("hub", "id")
        .agg(F.first("family").alias("family"), F.count("*").alias("bands"))
    )
    contexts = stored(contexts, "contexts")
    # The family with most classes under a hub; its own pairs need no search.
    counts = contexts.groupBy("hub", "family").agg(F.count("*").alias("n"))
    main = counts.groupBy("hub").agg(
        F.max(F.struct("n", "family")).getField("family").alias("main")
    )
    # Two classes with one other hub that is best for both are compared under that one.
    best = F.max(F.struct("bands", (-F.col("hub")).alias("hub"))).getField("hub")
    best = contexts.groupBy("id").agg((-best).alias("best"))
    contexts = contexts.join(stored(main, "main-families"), "hub").join(best, "id")
    r = _ratio(percent)
    rows = _around_consensus(stored(_apart_from_hub(contexts, texts, words), "hub-differences"), r)
    # Classes so near the consensus that their differences need not meet at all are
    # linked, each of them also with the nearest.
    nearest = F.min(F.struct("far", "id")).alias("nearest")
    nearest = rows.groupBy("hub").agg(nearest).select("hub", "nearest.*")
    nearest = nearest.select("hub", F.col("far").alias("x_far"), F.col("id").alias("x_id"))
    close = rows.join(nearest, "hub").where((F.col("far") + F.col("x_far") <= 1e-6) & (F.col("id") != F.col("x_id")))
    facts = ["family", "main", "best", "n", "far", F.size("apart").alias("size")]
    meeting = _rare_prefixes(rows, percent).join(rows.select("hub", "id", *facts), ["hub", "id"])
    meeting = stored(meeting, "rare-prefixes")
    place = ["hub", "shingle", "low", "high"]
    asking = meeting.where(F.col("family") != F.col("main")).select(
        *place, *[F.col(c).alias(f"x_{c}") for c in ("id", "family", "best", "n", "far", "size", "lower", "upper")]
    )
    possible = (
        (F.col("x_family") != F.col("family"))
        & ((F.col("x_lower") & F.col("upper")) | (F.col("x_upper") & F.col("lower")))
        & (F.lit(percent) * F.greatest("n", "x_n") <= 100 * F.least("n", "x_n"))
        & ((F.col("x_best") != F.col("best")) | (F.col("best") == F.col("hub")))
        & (F.col("far") + F.col("x_far") <= 2 * F.least("size", "x_size") + 1e-6)
    )
    pairs = asking.join(meeting, place).where(possible).select("x_id", "id").union(close.select("x_id", "id"))
    return pairs.select(F.greatest("x_id", "id").alias("a"), F.least("x_id", "id").alias("b")).distinct()
