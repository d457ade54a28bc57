"""Removal of repeated byte strings by a hash-compared suffix sort.

Every window of `LEAST` bytes has an anchor, the smallest hash of its `GRAM`-byte strings, so equal windows
have equal anchors wherever they stand. Runs of windows with one anchor are segments. Spark brings segments
together by anchor: those with the content of an earlier one are repeats as a whole, found in one ordered
pass. Only where an anchor has several contents are windows looked at one by one: a merge sort orders these
suffixes, comparing two by the length of their common prefix, which a binary search finds on prefix polynomial
hashes; bytes of neighbours that count as equal are compared in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shingles import chunks, mix, powers
from tidemark.session import settle

LEAST, GRAM = 100, 36
SPAN = LEAST - GRAM + 1  # anchors to choose from in a window
RUN = 5_000  # segments that are sorted in memory at once
LAST = 2**63 - 1  # stands for a null id: after all others
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
MARK = "kind int, anchor long, doc long, tag binary, lo int, n int"


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H[i]: polynomial hash of the first i bytes, modulo 2^64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data))[: len(data)], out=out[1:])
    return out


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """text, first window, number of windows, anchor and content hash of all segments of some texts."""
    n = len(data)
    if n < LEAST:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    h, inverse = prefix_hashes(data), powers(_INVERSE, n + 1)
    gram = mix((h[GRAM:] - h[:-GRAM]) * inverse[: n - GRAM + 1])
    # The leftmost smallest one: equal windows then have it at the same offset, also in text that repeats itself.
    least, where, width = gram, np.arange(len(gram), dtype=np.int32), 1
    while width < SPAN:
        step = min(width, SPAN - width)
        left = least[:-step] <= least[step:]
        least, where = np.where(left, least[:-step], least[step:]), np.where(left, where[:-step], where[step:])
        width += step
    lengths = np.diff(offsets)
    windows = np.maximum(0, lengths - LEAST + 1)
    valid = np.zeros(n + 1, dtype=np.int8)
    full = windows > 0
    np.add.at(valid, offsets[:-1][full], 1)
    np.add.at(valid, (offsets[:-1] + windows)[full], -1)
    inside = np.cumsum(valid[: len(least)]) > 0
    begins = np.append(True, where[1:] != where[:-1])
    begins[offsets[:-1][full]] = True
    lo = np.flatnonzero(begins & inside)
    doc = np.searchsorted(offsets, lo, side="right") - 1
    stop = np.minimum(np.append(lo[1:], n), (offsets[:-1] + windows)[doc])
    content = mix((h[stop + LEAST - 1] - h[lo]) * inverse[lo] + (stop - lo).astype(np.uint64))
    return doc, lo - offsets[doc], stop - lo, least[lo].view(np.int64), content.view(np.int64)


def common_prefix(h: np.ndarray, inverse: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of windows at a and b, by binary search on prefix hashes."""
    low, step = np.zeros(len(a), dtype=np.int64), 1 << LEAST.bit_length() - 1
    while step:
        far = np.minimum(low + step, LEAST)
        same = (h[a + far] - h[a]) * inverse[a] == (h[b + far] - h[b]) * inverse[b]
        low = np.where(same, far, low)
        step >>= 1
    return low


def suffix_order(data: np.ndarray, h: np.ndarray, inverse: np.ndarray, at: np.ndarray, whole: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows at `at` by group and content, ties as they come, and which equal the one before.

    `group` doesn't fall and `whole` has the windows' hashes. A bottom-up merge sort over all groups at once: where two
    runs meet within a group, each element of the group looks up its place in the sibling run.
    """
    n = len(at)
    ranks = np.arange(n)
    heads = np.append(True, group[1:] != group[:-1]) if n else np.zeros(0, dtype=bool)
    begin = np.flatnonzero(heads)[np.cumsum(heads) - 1] if n else ranks
    end = np.append(np.flatnonzero(heads)[1:], n)[np.cumsum(heads) - 1] if n else ranks

    def before(x: np.ndarray, y: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether window x comes before y; where `ties`, also if they are equal."""
        out = ties.copy()
        other = np.flatnonzero(whole[x] != whole[y])
        x, y = at[x[other]], at[y[other]]
        last = np.minimum(common_prefix(h, inverse, x, y), LEAST - 1)
        out[other] = data[x + last] < data[y + last]
        return out

    order, width = ranks.copy(), 1
    while width < n:
        middle = np.arange(width, n, 2 * width)
        middle = middle[group[middle - 1] == group[middle]]
        width *= 2
        if not len(middle):
            continue
        first, stop = np.maximum(middle - width // 2, begin[middle]), np.minimum(middle + width // 2, end[middle])
        size = stop - first
        pair = np.repeat(np.arange(len(middle)), size)
        rank = np.arange(len(pair)) - np.repeat(np.append(0, np.cumsum(size))[:-1], size) + first[pair]
        left = rank < middle[pair]
        low, high = np.where(left, middle[pair], first[pair]), np.where(left, stop[pair], middle[pair])
        todo = np.arange(len(rank))
        while len(todo):
            half = (low[todo] + high[todo]) // 2
            # A left element follows smaller right ones; a right one also follows equal left ones.
            follows = before(order[half], order[rank[todo]], ~left[todo])
            low[todo] = np.where(follows, half + 1, low[todo])
            high[todo] = np.where(follows, high[todo], half)
            todo = todo[low[todo] < high[todo]]
        place = np.where(left, rank, rank - middle[pair]) + low - np.where(left, middle[pair], 0)
        moved = order[rank]
        order[place] = moved
    equal = np.zeros(n, dtype=bool)
    if n > 1:
        equal[1:] = ~heads[1:] & (whole[order[:-1]] == whole[order[1:]])
        # Equal hashes aren't equal bytes yet.
        hit, step = np.flatnonzero(equal), np.arange(LEAST)
        for part in np.array_split(hit, len(hit) // 10_000 + 1):
            equal[part] = (data[at[order[part - 1]][:, None] + step] == data[at[order[part]][:, None] + step]).all(axis=1)
    return order, equal


def _emit(kind: int, anchor, doc, tag, lo, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(doc), kind, dtype=np.int32)),
            pa.array(np.asarray(anchor, dtype=np.int64)),
            pa.array(np.asarray(doc, dtype=np.int64)),
            tag.cast(pa.binary()),
            pa.array(np.asarray(lo, dtype=np.int32)),
            pa.array(np.asarray(n, dtype=np.int32)),
        ],
        ["kind", "anchor", "doc", "tag", "lo", "n"],
    )


def find_segments(docs: DataFrame) -> DataFrame:
    """doc, tag, text -> anchor, content, doc, place, tag; place orders by first window and carries the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            tags = batch.column(1)
            for row, data, offsets in chunks(batch.column(2)):
                doc, lo, n, anchor, content = segments(data, offsets)
                place = lo << 8 | n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(content), pa.array(ids[row + doc]), pa.array(place), tags.take(pa.array(row + doc))],
                    ["anchor", "content", "doc", "place", "tag"],
                )

    return docs.mapInArrow(run, "anchor long, content long, doc long, place long, tag binary")


def compare_segments(found: DataFrame) -> DataFrame:
    """Ordered by anchor, content and place: kind 0, repeats as a whole; kind 1, first ones of contents that share an anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, waiting = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, content, doc, place = (batch.column(i).to_numpy() for i in range(4))
            new_anchor = np.append(last is None or last[0] != anchor[0], anchor[1:] != anchor[:-1])
            new = new_anchor | np.append(last is None or last[1] != content[0], content[1:] != content[:-1])

            def rows(kind: int, at: np.ndarray, a=anchor, d=doc, p=place, t=batch.column(4)) -> pa.RecordBatch:
                return _emit(kind, a[at], d[at], t.take(pa.array(at)), p[at] >> 8, p[at] & 0xFF)

            yield rows(0, np.flatnonzero(~new))
            first = np.flatnonzero(new)
            if len(first):
                more = ~new_anchor[first]  # the anchor has a content before this one
                if more[0] and waiting is not None:
                    yield waiting
                if more[0] or len(first):
                    waiting = None
                shared = more | np.append(more[1:], False)
                yield rows(1, first[shared])
                if not shared[-1]:
                    waiting = rows(1, first[-1:])
            last = anchor[-1], content[-1]

    return found.repartition("anchor").sortWithinPartitions("anchor", "content", "doc", "place", "tag").mapInArrow(run, MARK)


def compare_windows(pieces: DataFrame) -> DataFrame:
    """anchor, doc, tag, lo, n, piece -> marks. Kind 0: repeated windows; kind 2: for anchors of more than one run,
    one window of each content of the run (lo), with its hash as anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_anchor = None  # an anchor that began in the run before
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= RUN:
                table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                anchor = table.column(0).to_numpy()
                if anchor[0] != anchor[RUN - 1]:  # up to where the last anchor begins
                    cut, broken = int(np.argmax(anchor == anchor[RUN - 1])), None
                else:  # an anchor fills the run alone
                    cut, broken = RUN, int(anchor[0])
                yield from sorted_run(table.slice(0, cut), {open_anchor, broken})
                open_anchor = broken
                held = [table.slice(cut)]
        if sum(b.num_rows for b in held):
            yield from sorted_run(pa.Table.from_batches(held).combine_chunks().to_batches()[0], {open_anchor})

    def sorted_run(batch: pa.RecordBatch, broken: set) -> Iterator[pa.RecordBatch]:
        if not batch.num_rows:
            return
        anchor, doc, lo, n = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 1, 3, 4))
        tag = batch.column(2)
        piece = batch.column(5).cast(pa.large_binary())
        _, where, data = piece.buffers()
        offsets = np.frombuffer(where, dtype=np.int64)[piece.offset : piece.offset + len(piece) + 1]
        data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        h, inverse = prefix_hashes(data), powers(_INVERSE, len(data) + 1)
        owner = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(owner)) - np.repeat(np.append(0, np.cumsum(n))[:-1], n)
        at = offsets[owner] + step
        window = mix((h[at + LEAST] - h[at]) * inverse[at] ^ anchor[owner].view(np.uint64))
        # Windows whose hash stands alone in the run repeat nothing in it.
        _, back, count = np.unique(window, return_inverse=True, return_counts=True)
        likely = np.flatnonzero(count[back] > 1)
        # By anchor, document and place, so that ties in the sort keep the earliest window first.
        likely = likely[np.lexsort((lo[owner[likely]] + step[likely], doc[owner[likely]], anchor[owner[likely]]))]
        order, equal = suffix_order(data, h, inverse, at[likely], window[likely], anchor[owner[likely]])
        repeated = np.zeros(len(owner), dtype=bool)
        repeated[likely[order[equal]]] = True
        hit = np.flatnonzero(repeated)
        if len(hit):
            # Neighbouring windows of a segment are one mark.
            breaks = np.append(True, (np.diff(hit) > 1) | (owner[hit[1:]] != owner[hit[:-1]]))
            first = hit[breaks]
            size = np.diff(np.append(np.flatnonzero(breaks), len(hit)))
            o = owner[first]
            yield _emit(0, anchor[o], doc[o], tag.take(pa.array(o)), lo[o] + step[first], size)
        parted = np.flatnonzero(np.isin(anchor[owner], [b for b in broken if b is not None]) & ~repeated)
        if len(parted):
            o = owner[parted]
            yield _emit(2, window[parted].view(np.int64), doc[o], tag.take(pa.array(o)), lo[o] + step[parted], np.ones(len(o)))

    ordered = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc", "lo", "tag")
    return ordered.select("anchor", "doc", "tag", "lo", "n", "piece").mapInArrow(run, MARK)


def cut_texts(docs: DataFrame, name: str = "spans") -> DataFrame:
    """doc, text, spans (array of lo << 32 | windows) -> doc, n_bytes, n_removed, n_spans, kept (bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                total, removed, runs, rest = [], [], [], []
                for text, spans in zip(part.column(1), part.column(2)):
                    data = (text.as_py() or "").encode()
                    total.append(len(data))
                    if not spans.is_valid or not len(spans):
                        removed.append(0)
                        runs.append(0)
                        rest.append(data)
                        continue
                    packed = np.sort(spans.values.to_numpy())
                    lo = packed >> 32
                    reach = np.maximum.accumulate(lo + (packed & 0xFFFFFFFF) + LEAST - 1)
                    begin = np.append(True, lo[1:] > reach[:-1])
                    starts, stops = lo[begin], reach[np.append(np.flatnonzero(begin)[1:] - 1, len(lo) - 1)]
                    removed.append(int((stops - starts).sum()))
                    runs.append(len(starts))
                    edges = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), len(data)]
                    rest.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(rest, pa.binary())],
                    ["doc", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return docs.select("doc", "text", name).mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept: one row per row of `docs`.

    Null text is empty. Null ids come after all others and are one document, like all rows that share an id: between
    their texts the earlier start counts, then a 128-bit digest of the text, which also tells them apart. Rows equal in id and text get one result, as
    if they stood there once. Texts of fewer than LEAST bytes stay whole; an empty table gives no rows.
    Other columns are ignored.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("doc"),
        F.unhex(F.md5(whole)).alias("tag"),
        whole.alias("text"),
    )
    # Rows equal in id and text would repeat themselves and double the pieces; only the cut sees all of them.
    once = own.dropDuplicates(["doc", "tag"])
    marks = settle(compare_segments(find_segments(once)), "marks")
    shared = marks.where("kind = 1").drop("kind")
    pieces = (
        shared.join(once, ["doc", "tag"])
        .select("anchor", "doc", "tag", "lo", "n", F.substring(F.col("text").cast("binary"), F.col("lo") + 1, F.col("n") + LEAST - 1).alias("piece"))
    )
    compared = settle(compare_windows(pieces), "windows")
    parted = compared.where("kind = 2")
    least = parted.groupBy("anchor").agg(F.min(F.struct("doc", "lo", "tag")).alias("least"), F.count("*").alias("m")).where("m > 1")
    later = parted.join(least, "anchor").where(F.struct("doc", "lo", "tag") != F.col("least"))
    columns = ("doc", "tag", "lo", "n")
    repeats = marks.where("kind = 0").select(*columns).unionByName(compared.where("kind = 0").select(*columns)).unionByName(later.select(*columns))
    spans = repeats.groupBy("doc", "tag").agg(F.collect_list(F.shiftleft(F.col("lo").cast("long"), 32) + F.col("n")).alias("spans"))
    cut = cut_texts(own.join(spans, ["doc", "tag"], "left"))
    return cut.withColumn("doc_id", F.when(F.col("doc") != LAST, F.col("doc"))).drop("doc")


def removal_digest(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
