"""Removing passages that start in an earlier document, by sorting suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.anchors import Anchors
from starmill.llm.common import releasing, releasing_group, utf8
from starmill.llm.runs import Runs, encode_run, from_planes, merged, planes

#: Bytes that must agree, and those of the run that anchors them.
MATCH, GRAM = 50, 24
#: Parts into which groups of documents and ranges of suffixes cut all bytes, and how
#: many bytes a group and a range have at least and at most, for what a task can hold.
PARTS = 1024
GROUP_BYTES, RANGE_BYTES = (8 << 20, 32 << 20), (8 << 20, 128 << 20)
#: Text whose anchors make a bucket of hash values; buckets at least.
BUCKET_BYTES, BUCKETS = 64 << 20, 1024
#: Anchors that a task gathers before it hands on their hashes.
GATHERED = 1_500_000
#: Documents whose suffixes show how to cut the key space, at least and for each of the
#: ranges, and suffixes of each.
SAMPLE_DOCS, SAMPLE_RANGE_DOCS, SAMPLE_SUFFIXES = 2000, 1, 16
_NO_ID = 2**63 - 1

_PACKED = pa.schema([("grp", pa.int32()), ("blob", pa.binary())])
_KEYED = "kind int, key int, grp int, blob binary"
RUN, REMOVED = 0, 1


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    """Rows of a group compressed together: what a text costs in a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grp = batch.column("grp").to_numpy()
            order = np.argsort(grp, kind="stable")
            ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
            nulls = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
            row_ids = batch.column("row_id").to_numpy()
            texts = batch.column("text")
            cuts = np.flatnonzero(np.diff(grp[order], prepend=-1))
            keys, blobs = [], []
            for rows in np.split(order, cuts[1:]) if len(order) else []:
                data = [texts[int(i)].as_py() for i in rows]
                head = np.array([len(rows)], "<i8")
                facts = np.stack([row_ids[rows], ids[rows], nulls[rows], [len(d) for d in data]])
                whole = b"".join([head.tobytes(), facts.astype("<i8").tobytes(), *data])
                keys.append(int(grp[rows[0]]))
                blobs.append(zstandard.compress(whole, 3))
            yield pa.RecordBatch.from_pydict({"grp": keys, "blob": blobs}, schema=_PACKED)

    rows = _rows(docs, groups)
    return rows.mapInArrow(releasing(pack), "grp int, blob binary")


def _rows(docs: DataFrame, groups: int) -> DataFrame:
    row_id = F.monotonically_increasing_id().alias("row_id")
    rows = docs.select(row_id, F.col("doc_id").cast("long"), utf8().alias("text"))
    return rows.withColumn("grp", F.pmod(F.xxhash64("row_id"), F.lit(groups)).cast("int"))


class _Texts:
    """The documents of a group, end to end."""

    def __init__(self, blobs: list[bytes]):
        facts, parts = [], []
        for blob in blobs:
            data = zstandard.decompress(blob)
            (n,) = np.frombuffer(data, "<i8", 1)
            facts.append(np.frombuffer(data, "<i8", 4 * n, 8).reshape(4, n))
            parts.append(np.frombuffer(data, np.uint8, offset=8 + 32 * n))
        self.row_ids, self.ids, self.nulls, sizes = np.concatenate(facts, axis=1)
        self.data = np.concatenate(parts)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])


def _codes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and code of a hash: its first bits and the 32 that follow."""
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int32)
    return bucket, (hashes >> np.uint64(32 - bits)).astype(np.uint32)


def _anchor_hashes(docs: DataFrame, groups: int, bits: int) -> DataFrame:
    """Per bucket the codes of anchors, with the groups that they occur in.

    The sign of a group says that two documents of one task have the code already.
    """
    schema = pa.schema([("bucket", pa.int32()), ("blob", pa.binary())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = seen = 0

        def leave() -> pa.RecordBatch:
            hashes, grp, doc = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((doc, grp, hashes))
            hashes, grp, doc = hashes[order], grp[order], doc[order]
            new = np.diff(hashes, prepend=~hashes[:1]) != 0
            of = np.cumsum(new) - 1
            shared = np.zeros(of[-1] + 1, bool)
            other = ~new[1:] & (doc[1:] != doc[:-1])
            shared[of[1:][other]] = True
            keep = new | (np.diff(grp, prepend=-1) != 0)
            hashes, grp, shared = hashes[keep], grp[keep], shared[of[keep]]
            bucket, code = _codes(hashes, bits)
            groups_ = np.where(shared, ~grp, grp).astype("<i4")
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
            ends = np.append(cuts[1:], len(bucket))
            blobs = [
                np.array([b - a], "<i8").tobytes()
                + planes(np.diff(code[a:b], prepend=np.uint32(0)), "<u4").tobytes()
                + _narrow(groups_[a:b], groups)
                for a, b in zip(cuts, ends)
            ]
            return pa.RecordBatch.from_pydict({"bucket": bucket[cuts], "blob": blobs}, schema=schema)

        for whole in batches:
            for at in range(0, len(whole), 512):
                batch = whole.slice(at, 512)
                texts = batch.column("text").to_pylist()
                data = np.frombuffer(b"".join(texts), np.uint8)
                starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
                anchors = Anchors.of(data, starts, GRAM, MATCH)
                if len(anchors.at):
                    grp = batch.column("grp").to_numpy()[anchors.text]
                    held.append((anchors.hashes(data, GRAM), grp, anchors.text + seen))
                    size += len(grp)
                seen += len(batch)
                if size >= GATHERED:
                    yield leave()
                    held, size = [], 0
        if size:
            yield leave()

    return _rows(docs, groups).select("grp", "text").mapInArrow(releasing(gather), "bucket int, blob binary")


def _narrow(groups_: np.ndarray, groups: int) -> bytes:
    return groups_.astype(_group_kind(groups)).tobytes()


def _group_kind(groups: int) -> str:
    return "<i1" if groups < 2**7 else "<i2" if groups < 2**15 else "<i4"


def _repeated_codes(groups: int):
    def repeated(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """(grp, bucket, codes) of the anchors that two documents share."""
        codes, grps = [], []
        kind = _group_kind(groups)
        for blob in frame["blob"]:
            (n,) = np.frombuffer(blob, "<i8", 1)
            codes.append(np.cumsum(from_planes(blob, n, 8, "<u4"), dtype=np.uint32))
            grps.append(np.frombuffer(blob, kind, n, 8 + 4 * n).astype(np.int64))
        code, grp = np.concatenate(codes), np.concatenate(grps)
        marked = grp < 0
        grp = np.where(marked, ~grp, grp)
        order = np.argsort(code, kind="stable")
        code, grp, marked = code[order], grp[order], marked[order]
        of = np.cumsum(np.diff(code.astype(np.int64), prepend=-1) != 0) - 1
        often = (np.bincount(of) > 1) | (np.bincount(of, marked) > 0)
        code, grp = code[often[of]], grp[often[of]]
        order = np.lexsort((code, grp))
        code, grp = code[order], grp[order]
        cuts = np.flatnonzero(np.diff(grp, prepend=-1))
        return pd.DataFrame(
            {
                "grp": grp[cuts].astype(np.int32),
                "bucket": np.full(len(cuts), key[0], np.int32),
                "codes": [c.tobytes() for c in np.split(code, cuts[1:])] if len(cuts) else [],
            }
        )

    return repeated


def _splitters(docs: DataFrame, n_docs: int, ranges: int) -> np.ndarray:
    """Strings that cut the sorted suffixes into ranges, from a sample of so many for
    each. Which documents it holds changes the balance of the tasks and nothing else."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text").to_pylist():
                step = max(1, len(text) // SAMPLE_SUFFIXES)
                found += [text[i : i + MATCH] for i in range(step // 2, len(text), step)][:SAMPLE_SUFFIXES]
            yield pa.RecordBatch.from_pydict({"suffix": pa.array(found, pa.binary())})

    wanted = max(SAMPLE_DOCS, SAMPLE_RANGE_DOCS * ranges)
    sample = docs.select(utf8().alias("text")).sample(min(1.0, wanted / max(1, n_docs)), seed=5)
    found = sample.mapInArrow(releasing(some), "suffix binary").toArrow().column("suffix")
    ordered = np.sort(np.array(found.to_pylist(), f"S{MATCH}"))
    return ordered[len(ordered) * np.arange(1, ranges) // ranges] if len(ordered) else ordered


def _runs(
    rows: np.ndarray, notes: np.ndarray, table: np.ndarray, splitters: np.ndarray
) -> Iterator[tuple[int, int, int, bytes]]:
    """Sorted rows as one front-coded run for every range."""
    if len(rows):
        heads = np.ascontiguousarray(rows[:, :MATCH]).view(f"S{MATCH}").ravel()
        key = np.searchsorted(splitters, heads, side="right") if len(splitters) else np.zeros(len(rows), int)
        cuts = np.flatnonzero(np.diff(key, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(key))):
            used, notes_ = np.unique(notes[a:b, 0], return_inverse=True)
            own = np.column_stack([notes_, notes[a:b, 1:]])
            yield RUN, int(key[a]), -1, encode_run(rows[a:b], own, table[used])


def _settle(rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows; which of the ordered ones have the smallest id of their equals."""
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")
    rows, ids = rows[order], ids[order]
    new = np.flatnonzero(common_start(rows))
    least = np.repeat(np.minimum.reduceat(ids, new), np.diff(np.append(new, len(ids))))
    return order, ids == least, rows


def common_start(rows: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    out = np.ones(len(rows), bool)
    out[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    return out


def _spans(row_ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(row_id, start, end) with touching spans of a document joined, sorted."""
    if not len(row_ids):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((starts, row_ids))
    row_ids, starts, ends = row_ids[order], starts[order], ends[order]
    # The furthest end so far in its document: ids are made numbers that only rise.
    _, number = np.unique(row_ids, return_inverse=True)
    reach = int(ends.max()) + 1
    furthest = np.maximum.accumulate(ends + number * reach) - number * reach
    new = np.ones(len(starts), bool)
    new[1:] = (row_ids[1:] != row_ids[:-1]) | (starts[1:] > furthest[:-1])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(starts)) - 1
    return np.column_stack([row_ids[heads], starts[heads], furthest[last]])


def without_spans(text: str | None, spans: list | None) -> str | None:
    """A text without byte spans (start, end); a character that one cuts goes as a whole."""
    if text is None or not spans:
        return text
    data, kept, at = text.encode(), [], 0
    for span in spans:
        begin, end = span["start"], span["end"]
        while data[begin] & 0xC0 == 0x80:
            begin -= 1
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        kept.append(data[at : max(at, begin)])
        at = end
    return b"".join([*kept, data[at:]]).decode()


def _removed(
    spans: np.ndarray, groups_of: np.ndarray, ranges: int
) -> Iterator[tuple[int, int, int, bytes]]:
    """Spans by group of their document. They travel with the runs, whose next task
    passes them on, so that nothing but this one exchange has to hold either."""
    order = np.argsort(groups_of, kind="stable")
    spans, groups_of = spans[order], groups_of[order]
    cuts = np.flatnonzero(np.diff(groups_of, prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(groups_of))):
        grp = int(groups_of[a])
        yield REMOVED, grp % ranges, grp, zstandard.compress(spans[a:b].astype("<i8").tobytes(), 3)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["kind", "key", "grp", "blob"])


#: A context: the bytes from an anchor on, those before it backwards, and how many
#: of either there are in the document.
_RIGHT, _LEFT = MATCH, MATCH - GRAM
_CONTEXT = _RIGHT + _LEFT + 2


def _contexts(texts: _Texts, anchors: Anchors, some: np.ndarray) -> np.ndarray:
    at, text = anchors.at[some], anchors.text[some]
    right = np.minimum(_RIGHT, texts.starts[text + 1] - at)
    left = np.minimum(_LEFT, at - texts.starts[text])
    rows = np.empty((len(at), _CONTEXT), np.uint8)
    after, before = np.arange(_RIGHT), np.arange(1, _LEFT + 1)
    for a in range(0, len(at), 1 << 15):
        b = slice(a, a + (1 << 15))
        place = np.minimum(at[b, None] + after, len(texts.data) - 1)
        rows[b, :_RIGHT] = np.where(after < right[b, None], texts.data[place], 255)
        place = np.maximum(at[b, None] - before, 0)
        rows[b, _RIGHT : _RIGHT + _LEFT] = np.where(before <= left[b, None], texts.data[place], 255)
    rows[:, -2], rows[:, -1] = right, left
    return rows


def _context_runs(splitters: np.ndarray, bits: int):
    def make(key: tuple, packed: pd.DataFrame, repeated: pd.DataFrame) -> pd.DataFrame:
        """Runs of the contexts of anchors that two documents share. Of equal contexts
        only those of the smallest document go on; the others are settled here."""
        if packed.empty or repeated.empty:
            return _frame([])
        texts = _Texts(list(packed["blob"]))
        known = np.concatenate(
            [
                np.frombuffer(c, "<u4").astype(np.uint64) | (np.uint64(b) << np.uint64(32))
                for b, c in zip(repeated["bucket"], repeated["codes"])
            ]
        )
        known.sort()
        anchors = Anchors.of(texts.data, texts.starts, GRAM, MATCH)
        bucket, code = _codes(anchors.hashes(texts.data, GRAM), bits)
        full = code.astype(np.uint64) | (bucket.astype(np.uint64) << np.uint64(32))
        at = np.minimum(np.searchsorted(known, full), len(known) - 1)
        some = np.flatnonzero(known[at] == full)
        if not len(some):
            return _frame([])
        rows = _contexts(texts, anchors, some)
        text = anchors.text[some]
        order, first, rows = _settle(rows, texts.ids[text])
        some, text = some[order], text[order]
        base = texts.starts[text]
        begin, end = anchors.first[some] - base, anchors.last[some] - base + MATCH
        gone = _spans(texts.row_ids[text[~first]], begin[~first], end[~first])
        at = anchors.at[some] - base
        notes = np.column_stack(
            [text, at, 256 * (anchors.at - anchors.last)[some] + (anchors.at - anchors.first)[some]]
        )[first]
        table = np.column_stack([texts.ids, texts.row_ids, np.full(len(texts.ids), key[0])])
        out = list(_runs(rows[first], notes, table, splitters))
        out += _removed(gone, np.full(len(gone), key[0]), len(splitters) + 1)
        return _frame(out)

    return make


def _merged_contexts(splitters: np.ndarray):
    def merge(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        """Equal contexts of a range: all but those of the smallest document are removed
        whole. The others hand on, as strings of their own, the windows that a
        neighbour of another context may share."""
        passed = frame["kind"] == REMOVED
        out = [tuple(row) for row in frame[passed].itertuples(index=False)]
        if passed.all():
            return _frame(out)
        runs = Runs(list(frame.loc[~passed, "blob"]))
        order, shared = merged(runs)
        facts = runs.table[runs.entry[order]]
        at, back = (note[order] for note in runs.notes)
        nearest, furthest = back // 256, back % 256
        heads = np.flatnonzero(shared < _CONTEXT)
        sizes = np.diff(np.append(heads, len(order)))
        lost = facts[:, 0] != np.repeat(np.minimum.reduceat(facts[:, 0], heads), sizes)
        # Neighbours beyond the range are unknown and may share everything.
        before = np.append(_RIGHT, shared[heads[1:]])
        reach = np.minimum(_RIGHT, np.maximum(before, np.append(before[1:], _RIGHT)))
        ranges = len(splitters) + 1
        out += _gone_rows(facts[lost], at[lost] - furthest[lost], at[lost] - nearest[lost] + MATCH, ranges)
        low = np.maximum(nearest, MATCH - np.repeat(reach, sizes))
        windows = np.where(lost, 0, np.maximum(0, furthest + 1 - low))
        of = np.repeat(np.arange(len(order)), windows)
        if len(of):
            back = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
            rows = _windows(runs.rows, order[of], back)
            facts, at = facts[of], at[of] - back
            order, first, rows = _settle(rows, facts[:, 0])
            facts, at = facts[order], at[order]
            out += _gone_rows(facts[~first], at[~first], at[~first] + MATCH, ranges)
            _, entry, number = np.unique(facts[first, 1], return_index=True, return_inverse=True)
            notes = np.column_stack([number, at[first]])
            out += _runs(rows[first], notes, facts[first][entry], splitters)
        return _frame(out)

    return merge


def _windows(contexts: np.ndarray, of: np.ndarray, back: np.ndarray) -> np.ndarray:
    """The strings of contexts that start so far before their anchor."""
    rows = np.empty((len(of), MATCH), np.uint8)
    place = np.arange(MATCH)
    for a in range(0, len(of), 1 << 15):
        b = slice(a, a + (1 << 15))
        after = place - back[b, None]
        rows[b] = contexts[of[b, None], np.where(after < 0, _RIGHT - 1 - after, after)]
    return rows


def _gone_rows(facts: np.ndarray, begin: np.ndarray, end: np.ndarray, ranges: int) -> list[tuple]:
    """Removed spans of documents known by (doc_id, row_id, grp)."""
    if not len(facts):
        return []
    spans = _spans(facts[:, 1], begin, end)
    row_ids, entry = np.unique(facts[:, 1], return_index=True)
    grp = facts[entry[np.searchsorted(row_ids, spans[:, 0])], 2]
    return list(_removed(spans, grp, ranges))


def _merged_windows(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    """Equal windows of a range: all but those of the smallest document are removed."""
    passed = frame["kind"] == REMOVED
    out = [tuple(row) for row in frame[passed].itertuples(index=False)]
    if passed.all():
        return _frame(out)
    runs = Runs(list(frame.loc[~passed, "blob"]))
    order, shared = merged(runs)
    facts, at = runs.table[runs.entry[order]], runs.notes[0][order]
    heads = np.flatnonzero(shared < MATCH)
    sizes = np.diff(np.append(heads, len(order)))
    lost = facts[:, 0] != np.repeat(np.minimum.reduceat(facts[:, 0], heads), sizes)
    return _frame(out + _gone_rows(facts[lost], at[lost], at[lost] + MATCH, 1))


KEPT = "row_id long, doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"


def _kept(key: tuple, packed: pd.DataFrame, removed: pd.DataFrame) -> pd.DataFrame:
    """The documents of a group without their removed spans."""
    if packed.empty:
        return pd.DataFrame(columns=["row_id", "doc_id", "n_bytes", "n_removed", "spans", "kept"])
    texts = _Texts(list(packed["blob"]))
    parts = [np.frombuffer(zstandard.decompress(b), "<i8").reshape(-1, 3) for b in removed["blob"]]
    all_spans = np.concatenate(parts) if parts else np.zeros((0, 3), np.int64)
    all_spans = _spans(*all_spans.T)
    order = np.argsort(texts.row_ids)
    first = np.searchsorted(all_spans[:, 0], texts.row_ids, side="left")
    last = np.searchsorted(all_spans[:, 0], texts.row_ids, side="right")
    out = []
    for i in order:
        data = texts.data[texts.starts[i] : texts.starts[i + 1]]
        spans = all_spans[first[i] : last[i], 1:]
        keep = np.ones(len(data), bool)
        for a, b in spans:
            keep[a:b] = False
        doc_id = None if texts.nulls[i] else int(texts.ids[i])
        pairs = [{"start": int(a), "end": int(b)} for a, b in spans]
        out.append((int(texts.row_ids[i]), doc_id, len(data), int((~keep).sum()), pairs, data[keep].tobytes()))
    frame = pd.DataFrame(out, columns=["row_id", "doc_id", "n_bytes", "n_removed", "spans", "kept"])
    return frame.astype({"doc_id": "Int64"})


def _parts(n_bytes: int, bounds: tuple[int, int]) -> int:
    """Parts of about the same size: PARTS of them as long as that is within the bounds,
    so that neither tasks nor the number of runs between them grow alone."""
    least, most = bounds
    return -(-n_bytes // min(most, max(least, n_bytes // PARTS)))


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, n_bytes, n_removed, spans and kept bytes of every row of ``docs``.

    A byte is removed if a string of 50 bytes over it also starts in a document with a
    smaller doc_id, whatever is removed there. ``spans`` are the maximal removed runs.

    A suffix can only agree with another over 50 bytes if both hold the same anchor, a
    run of 24 bytes chosen by content. A first exchange of anchor hashes finds the ones
    that two documents share. Tasks then sort the contexts of those anchors and exchange
    them as front-coded runs by range; loser trees that know common prefixes merge them.
    Equal contexts settle all their windows at once; where a neighbour agrees in part,
    the windows in question are sorted, exchanged and merged in the same way. Of equal
    strings, a task hands on those of its smallest document only, so a passage of a
    third of all documents is one entry per task.

    Null and empty texts have no bytes; texts under 50 bytes keep all; rows that share
    a doc_id are not earlier than one another; a null doc_id counts as later than any
    other. Empty tables give no rows. ``docs`` must be a table that is read the same way
    again, as rows are told apart by their place, the monotonically increasing id that
    is returned as ``row_id``. Other columns are ignored.
    """
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0))
    n_docs, n_bytes = docs.agg(F.count(F.lit(1)), size).first()
    groups = max(16, _parts(n_bytes, GROUP_BYTES))
    ranges = max(12, _parts(n_bytes, RANGE_BYTES))
    bits = (max(BUCKETS, n_bytes // BUCKET_BYTES) - 1).bit_length()
    splitters = _splitters(docs, n_docs, ranges)
    repeated = (
        _anchor_hashes(docs, groups, bits)
        .groupBy("bucket")
        .applyInPandas(releasing_group(_repeated_codes(groups)), "grp int, bucket int, codes binary")
    )
    contexts = (
        _grouped(docs, groups)
        .groupBy("grp")
        .cogroup(repeated.groupBy("grp"))
        .applyInPandas(releasing_group(_context_runs(splitters, bits), 2), _KEYED)
    )
    settled = releasing_group(_merged_contexts(splitters))
    windows = contexts.groupBy("key").applyInPandas(settled, _KEYED)
    removed = windows.groupBy("key").applyInPandas(releasing_group(_merged_windows), _KEYED)
    removed = removed.select("grp", "blob").groupBy("grp")
    kept = releasing_group(_kept, 2)
    return _grouped(docs, groups).groupBy("grp").cogroup(removed).applyInPandas(kept, KEPT)
