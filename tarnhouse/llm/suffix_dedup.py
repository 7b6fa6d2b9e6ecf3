"""Operator 1, exact substring dedup with suffix arrays.

Every byte that lies in a string of ``length`` bytes which also starts earlier is removed. A suffix
array of everything does not fit in any task, so the work is cut into shards by content:

1. Documents are numbered once and stored in blocks. Blocks pick anchors: in each window of ``length`` bytes, the 32 bytes with the
   smallest hash. Equal windows have equal anchors, so a window whose anchor occurs once in the
   corpus is unique. Anchors of all blocks meet by hash, and the repeated ones are told.
2. Around repeated anchors, windows are dealt into cells of a few starts; the bytes that all
   windows of a cell share are its key. Keys meet by hash. Where all occurrences have the same
   surroundings, the earliest stays and the others are covered whole; this settles the inside of
   copies, however many there are.
3. Cells with differing surroundings send these to shards by key. Each shard sorts its suffixes by
   induced sorting; runs with a common prefix of ``length`` bytes are equal windows, and all but
   the earliest are covered. Keys with very many surroundings, the ends of very common passages,
   are cut into single windows first and settled as in step 2.
4. Covered stretches return to their blocks, where the remaining bytes are put together.

Between the steps travel packed rows by block and bucket; a block counts each key once, so a
common key is no hot key. Documents come in order of id, then row; a null id comes last.

A null text is empty. Rows are documents one by one, also repeated ones; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnhouse.llm.blocks import pack, unpack
from tarnhouse.llm.common import Stored, release, shuffle_width
from tarnhouse.llm.suffix_array import permuted_common_prefixes, suffix_array

ANCHOR = 32
CELL = 18
BLOCK_BYTES = 4 << 20
PIECE = 1 << 20  # windows handled at once, to bound memory in long texts
ROWS = "block long, bucket int, kind int, data binary"
BLOCKS = "block long, data binary"
NO_ID = np.iinfo(np.int64).max

_rng = np.random.default_rng(7919)
BYTE_CODES = _rng.integers(0, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(0, 1 << 62)) * 8 + 5
BASE_INVERSE = pow(BASE, -1, 1 << 64)

UNIQUE, FIRST, LATER, MIXED, MANY = range(5)
CELLS, WINDOWS = 0, 1


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Bytes:
    """Documents of a block end to end, in order of id and row, with hashes of any stretch."""

    def __init__(self, docs: np.ndarray, rows: np.ndarray, sizes: np.ndarray, data: bytes, no_id: np.ndarray, piece: int = PIECE):
        self.piece = piece
        self.found: tuple[np.ndarray, ...] = ()  # the anchors, once they are known
        self.docs, self.rows, self.no_id = docs, rows, no_id
        self.data = np.frombuffer(data, dtype=np.uint8)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        n = len(self.data)
        self.inverse = powers(BASE_INVERSE, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(BYTE_CODES[self.data] * powers(BASE, n), out=self.sums[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the bytes from a to b, wherever they are."""
        h = (self.sums[b] - self.sums[a]) * self.inverse[a]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, at, side="right")

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of anchors, and the first and last start of the windows that chose each."""
        found = [self.piece_anchors(a, length) for a in range(0, len(self.data) - length + 1, self.piece)]
        if not found:
            return (np.empty(0, dtype=np.int64),) * 3
        places, firsts, lasts = (np.concatenate(x) for x in zip(*found, strict=True))
        # Windows on both sides of a border between pieces can have the same anchor: it is one.
        new = np.ones(len(places), dtype=bool)
        new[1:] = places[1:] != places[:-1]
        return places[new], firsts[new], lasts[np.append(new[1:], True)] if len(places) else lasts

    def piece_anchors(self, start: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = length - ANCHOR + 1
        stop = min(start + self.piece, len(self.data) - length + 1)
        at = np.arange(start, stop + width - 1)
        # The hash with the place in its low bits: of equal hashes the leftmost wins.
        low = np.uint64((1 << 24) - 1)
        keys = (self.hash(at, at + ANCHOR) & ~low) | np.arange(len(at), dtype=np.uint64)
        size = 1
        while 2 * size <= width:
            keys = np.minimum(keys[:-size], keys[size:])
            size *= 2
        if size < width:
            keys = np.minimum(keys[: size - width], keys[width - size :])
        chosen = (keys & low).astype(np.int64) + start
        # Windows that reach into the next document are none.
        windows = np.arange(start, stop)
        windows = windows[windows + length <= self.ends[self.doc_of(windows)]]
        chosen = chosen[windows - start]
        change = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]])) if len(chosen) else windows[:0]
        return chosen[change], windows[change], windows[np.append(change[1:], len(chosen)) - 1] if len(chosen) else change

    def cells(self, anchors, firsts, lasts, length: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each cell: its key, and the first and last window start inside the document."""
        width = length - ANCHOR + 1
        count = -(-width // size)
        base = anchors - (width - 1)
        keys, low, high = [], [], []
        doc = self.doc_of(anchors)
        for e in range(count):
            c0, c1 = base + e * size, base + min(e * size + size - 1, width - 1)
            use = (c0 <= lasts) & (c1 >= firsts)
            c0, c1 = c0[use], c1[use]
            keys.append(self.hash(c1, c0 + length))
            low.append(np.maximum(c0, self.starts[doc[use]]))
            high.append(np.minimum(c1, self.ends[doc[use]] - length))
        return np.concatenate(keys), np.concatenate(low), np.concatenate(high)


def text_blocks(docs: DataFrame, length: int, block_bytes: int, piece: int) -> DataFrame:
    """Blocks of documents as packed rows, with their anchors."""

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for rid, doc, text in zip(batch["rid"], batch["doc_id"], batch["text"], strict=True):
                data = text.encode()
                held.append((doc is None, NO_ID if doc is None else int(doc), int(rid), data))
                size += len(data)
                if size >= block_bytes or len(held) >= 100_000:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    def packed(held: list[tuple]) -> pd.DataFrame:
        name = held[0][2]
        held.sort(key=lambda d: d[:3])
        arrays = [np.array([d[k] for d in held], dtype=t) for k, t in ((1, "i8"), (2, "i8"), (0, "u1"))]
        sizes = np.array([len(d[3]) for d in held], dtype=np.int64)
        joined = b"".join(d[3] for d in held)
        places, firsts, lasts = Bytes(arrays[0], arrays[1], sizes, joined, arrays[2], piece).anchors(length)
        steps = np.diff(places, prepend=0).astype(np.int32)
        anchors = (steps, (places - firsts).astype(np.uint16), (places - lasts).astype(np.uint16))
        data = pack(*arrays, sizes, joined, *anchors, level=3)  # written once and shuffled three times
        return pd.DataFrame({"block": [name], "data": [data]})

    keyed = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col("doc_id").cast("string").alias("doc_id"),  # pandas has no null in whole numbers
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return keyed.mapInPandas(gather, BLOCKS)


def opened(data: bytes) -> Bytes:
    docs, rows, no_id, sizes, text, steps, firsts, lasts = unpack(data, "i8", "i8", "u1", "i8", "", "i4", "u2", "u2")
    out = Bytes(docs, rows, sizes, text, no_id)
    places = np.cumsum(steps, dtype=np.int64)
    out.found = (places, places - firsts, places - lasts)
    return out


def bucket_slices(keys: np.ndarray, n_buckets: int) -> Iterator[tuple[int, slice, np.ndarray]]:
    """Sorted keys by bucket: bucket, and the places of its keys."""
    if not len(keys):
        return
    buckets = (mixed_bits(keys) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(buckets, kind="stable")
    own = buckets[order]
    firsts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    for a, b in zip(firsts, [*firsts[1:], len(own)], strict=True):
        yield int(own[a]), order[a:b]


def mixed_bits(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["block", "bucket", "kind", "data"])


def anchor_rows(text: Bytes, block: int, n_buckets: int) -> list[tuple]:
    places = text.found[0]
    keys, counts = np.unique(text.hash(places, places + ANCHOR), return_counts=True)
    return [
        (block, bucket, CELLS, pack(keys[own], (counts[own] > 1).astype(np.uint8)))
        for bucket, own in bucket_slices(keys, n_buckets)
    ]


def repeated_anchors(group: pd.DataFrame) -> pd.DataFrame:
    """For each row of one bucket, which of its anchors occur more than once in the corpus."""
    rows = [unpack(data, "u8", "u1") for data in group["data"]]
    keys = np.concatenate([k for k, _ in rows])
    distinct, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    many = counts > 1
    many[at[np.concatenate([d for _, d in rows]) > 0]] = True
    told, a = [], 0
    for (own, _), block, bucket in zip(rows, group["block"], group["bucket"], strict=True):
        told.append((block, bucket, CELLS, pack(own[many[at[a : a + len(own)]]])))
        a += len(own)
    return frame(told)


class Cells:
    """The cells of a block around repeated anchors, by key and surroundings."""

    def __init__(self, text: Bytes, told: list[bytes], length: int):
        self.text, self.length = text, length
        repeated = np.sort(np.concatenate([unpack(t, "u8")[0] for t in told] or [np.empty(0, np.uint64)]))
        self.anchors = text.found
        hashes = text.hash(self.anchors[0], self.anchors[0] + ANCHOR)
        self.anchors = tuple(x[np.isin(hashes, repeated)] for x in self.anchors)
        self.fill(*self.anchors, CELL)

    def fill(self, anchors, firsts, lasts, size: int) -> None:
        keys, low, high = self.text.cells(anchors, firsts, lasts, self.length, size)
        around = self.text.hash(low, high + self.length)
        order = np.lexsort((low, around, keys))
        self.keys, self.low, self.high, self.around = keys[order], low[order], high[order], around[order]
        n = len(order)
        new_key = np.ones(n, dtype=bool)
        new_key[1:] = self.keys[1:] != self.keys[:-1]
        self.new_around = new_key.copy()
        self.new_around[1:] |= self.around[1:] != self.around[:-1]
        self.key_no = np.cumsum(new_key) - 1
        self.distinct = self.keys[new_key]
        self.surroundings = np.bincount(self.key_no[self.new_around], minlength=len(self.distinct))
        # Cells come by place within equal surroundings, so this is the first of a single one.
        self.leaders = np.flatnonzero(new_key)

    def rows(self, block: int, n_buckets: int, kind: int, only: np.ndarray | None = None) -> list[tuple]:
        text, out = self.text, []
        lead = self.low[self.leaders]
        doc = text.doc_of(lead)
        for bucket, own in bucket_slices(self.distinct, n_buckets):
            counts = np.minimum(self.surroundings[own], 255).astype(np.uint8)
            at = lead[own]
            out.append((
                block, bucket, kind,
                pack(self.distinct[own], self.around[self.leaders[own]], counts, text.docs[doc[own]],
                     text.rows[doc[own]], (at - text.starts[doc[own]]).astype(np.uint32)),
            ))
        return out

    def classes(self, told: dict[int, bytes], n_buckets: int) -> np.ndarray:
        """The class of each distinct key, from the rows that came back."""
        out = np.zeros(len(self.distinct), dtype=np.uint8)
        for bucket, own in bucket_slices(self.distinct, n_buckets):
            out[own] = unpack(told[bucket], "u1")[0]
        return out

    def covered(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches covered because an equal cell came earlier, in this block or in another."""
        by_cell = classes[self.key_no]
        single = self.surroundings[self.key_no] == 1
        later = ~self.new_around | (single & (by_cell == LATER))
        later &= (by_cell != MANY) & (self.high >= self.low)
        return self.low[later], self.high[later] + self.length


def settle(group: pd.DataFrame, many: int) -> pd.DataFrame:
    """For each row of one bucket, the class of each of its keys."""
    rows = [unpack(data, "u8", "u8", "u1", "i8", "i8", "u4") for data in group["data"]]
    keys, around, counts, docs, lines, places = (np.concatenate([r[k] for r in rows]) for k in range(6))
    order = np.lexsort((places, lines, docs, keys))
    sorted_keys = keys[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    number = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    size = np.bincount(number, minlength=len(first))
    total = np.bincount(number, weights=counts[order], minlength=len(first))
    other = (around[order] != around[order][first][number]) | (counts[order] > 1)
    differs = np.bincount(number, weights=other, minlength=len(first)) > 0
    kinds = np.where(differs, np.where(total > many, MANY, MIXED), np.where(size > 1, LATER, UNIQUE))[number]
    kinds[new & (kinds == LATER)] = FIRST
    out = np.empty(len(order), dtype=np.uint8)
    out[order] = kinds
    told, a = [], 0
    for r, block, bucket, kind in zip(rows, group["block"], group["bucket"], group["kind"], strict=True):
        told.append((block, bucket, kind, pack(out[a : a + len(r[0])])))
        a += len(r[0])
    return frame(told)


def surrounding_rows(cells: Cells, classes: np.ndarray, block: int, n_buckets: int) -> list[tuple]:
    """One row per bucket with the differing surroundings of its keys."""
    text, out = cells.text, []
    use = np.flatnonzero(cells.new_around & (classes[cells.key_no] == MIXED) & (cells.high >= cells.low))
    by_key = cells.keys[use]
    for bucket, own in bucket_slices(by_key, n_buckets):
        at = use[own]
        a, b = cells.low[at], cells.high[at] + cells.length
        data = b"".join([text.data[x:y].tobytes() for x, y in zip(a.tolist(), b.tolist(), strict=True)])
        doc = text.doc_of(a)
        places = (a - text.starts[doc]).astype(np.int64)
        out.append((
            block, bucket, CELLS,
            pack((b - a).astype(np.uint32), text.docs[doc], text.rows[doc], places, a.astype(np.int64), data),
        ))
    return out


def shard_suffixes(group: pd.DataFrame, length: int) -> pd.DataFrame:
    """Stretches covered within one shard: equal windows but the earliest, by a suffix array."""
    rows = [unpack(data, "u4", "i8", "i8", "i8", "i8", "") for data in group["data"]]
    sizes, docs, lines, places, local = (np.concatenate([r[k] for r in rows]).astype(np.int64) for k in range(5))
    block_no = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    data = np.frombuffer(b"".join(r[5] for r in rows), dtype=np.uint8).astype(np.int64)
    # Each stretch is followed by a separator; a sentinel ends the text.
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    s = np.ones(len(data) + n + 1, dtype=np.int64)
    s[np.arange(len(data)) + owner] = data + 2
    s[-1] = 0
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    order = suffix_array(s, 258)
    stretch = np.append(np.repeat(np.arange(n), sizes + 1), n - 1)[order]
    inside = order - starts[stretch]
    window = inside + length <= sizes[stretch]
    order, stretch, inside = order[window], stretch[window], inside[window]
    # Equal windows stand together, also with the other suffixes left out.
    number = np.cumsum(permuted_common_prefixes(s, order, length)[order] < length)
    by_age = np.lexsort((places[stretch] + inside, lines[stretch], docs[stretch], number))
    number, stretch, inside = number[by_age], stretch[by_age], inside[by_age]
    later = np.flatnonzero(number[1:] == number[:-1]) + 1
    # The same window can come in several stretches; only another place counts as earlier.
    place = local[stretch] + inside
    head = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    oldest = np.repeat(head, np.diff(np.append(head, len(number)))) if len(number) else head
    other = (block_no[stretch[later]] != block_no[stretch[oldest[later]]]) | (place[later] != place[oldest[later]])
    later = later[other]
    out = []
    for k, block in enumerate(group["block"]):
        own = np.unique(place[later[block_no[stretch[later]] == k]])
        if len(own):
            a, b = runs(own)
            out.append((block, 0, CELLS, pack(a, b + length)))
    return frame(out)


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places as runs of consecutive ones: first and last of each."""
    gap = np.flatnonzero(np.diff(places) > 1)
    return places[np.concatenate([[0], gap + 1]).astype(np.int64)], places[np.append(gap, len(places) - 1)]


def spans_of(block: int, text: Bytes, covered: list[bytes]) -> pd.DataFrame:
    """Each document's kept bytes and removed runs."""
    n = len(text.data)
    change = np.zeros(n + 1, dtype=np.int64)
    for data in covered:
        a, b = unpack(data, "i8", "i8")
        np.add.at(change, a, 1)
        np.add.at(change, b, -1)
    gone = np.cumsum(change[:-1]) > 0
    rows = []
    for k, (a, b) in enumerate(zip(text.starts.tolist(), text.ends.tolist(), strict=True)):
        own = gone[a:b]
        edges = np.flatnonzero(np.diff(own, prepend=False, append=False))
        spans = edges.reshape(-1, 2)
        kept = text.data[a:b][~own].tobytes()
        doc = None if text.no_id[k] else str(text.docs[k])
        rows.append((int(text.rows[k]), doc, b - a, kept, [{"start": int(x), "end": int(y)} for x, y in spans]))
    return pd.DataFrame(rows, columns=["rid", "doc_id", "n_bytes", "kept", "removed"])


def remove_repeats(
    docs: DataFrame, length: int = 100, many: int = 2000, block_bytes: int = BLOCK_BYTES, piece: int = PIECE
) -> DataFrame:
    """rid, doc_id, n_bytes, kept (the remaining bytes) and removed (byte spans) of each row.

    ``many`` is the number of differing surroundings from which a key is cut into single windows.
    Rows are numbered once, in blocks of about ``block_bytes`` that are stored; ``piece`` windows
    are handled at once. Neither changes the result.
    """
    if not ANCHOR + CELL <= length < 1 << 16:
        raise ValueError(f"strings must have {ANCHOR + CELL} bytes at least, and less than 65,536")
    spark = docs.sparkSession
    n_buckets = 8 * shuffle_width(spark)
    blocks = Stored(text_blocks(docs, length, block_bytes, piece), "text-blocks", packed=True).df

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for block, data in zip(batch["block"], batch["data"], strict=True):
                yield frame(anchor_rows(opened(data), block, n_buckets))

    def of_kind(rows: pd.DataFrame, kind: int) -> pd.DataFrame:
        return rows[rows["kind"] == kind]

    def second(block_rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if block_rows.empty or told.empty:
            return frame([])
        block = int(block_rows["block"].iloc[0])
        cells = Cells(opened(block_rows["data"].iloc[0]), list(told["data"]), length)
        return frame(cells.rows(block, n_buckets, CELLS))

    def third(block_rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        """Covered stretches (bucket -1), surroundings for shards, and single windows to settle."""
        if block_rows.empty or told.empty:
            return frame([])
        block = int(block_rows["block"].iloc[0])
        repeated = told[told["step"] == 1]
        cells = Cells(opened(block_rows["data"].iloc[0]), list(repeated["data"]), length)
        answers = told[told["step"] == 2]
        classes = cells.classes(dict(zip(answers["bucket"], answers["data"], strict=True)), n_buckets)
        out = [(block, -1, CELLS, pack(*cells.covered(classes)))]
        out += surrounding_rows(cells, classes, block, n_buckets)
        if single_windows(cells, classes):
            out += cells.rows(block, n_buckets, WINDOWS)
        return frame(out)

    def single_windows(cells: Cells, classes: np.ndarray) -> bool:
        """Turns the cells of MANY keys into cells of one window each; False if there are none."""
        use = (classes[cells.key_no] == MANY) & (cells.high >= cells.low)
        if not use.any():
            return False
        low, high = cells.low[use], cells.high[use]
        sizes = high - low + 1
        starts = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        starts = np.unique(starts)
        # A window as a cell of its own: key and surroundings are the window.
        width = length - ANCHOR
        cells.fill(starts + width, starts, starts, 1)
        return True

    def fourth(block_rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if block_rows.empty:
            return pd.DataFrame(columns=["rid", "doc_id", "n_bytes", "kept", "removed"])
        block = int(block_rows["block"].iloc[0])
        text = opened(block_rows["data"].iloc[0])
        covered = list(told["data"][told["step"] == 3])
        answers = told[told["step"] == 4]
        if len(answers):
            cells = Cells(text, list(told["data"][told["step"] == 1]), length)
            earlier = told[told["step"] == 2]
            classes = cells.classes(dict(zip(earlier["bucket"], earlier["data"], strict=True)), n_buckets)
            single_windows(cells, classes)
            classes = cells.classes(dict(zip(answers["bucket"], answers["data"], strict=True)), n_buckets)
            covered.append(pack(*cells.covered(classes)))
        return spans_of(block, text, covered)

    def shards(rows: DataFrame, work) -> DataFrame:
        return rows.groupBy("bucket").applyInPandas(work, ROWS)

    def with_blocks(told: DataFrame, work, schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(work, schema)

    def at_step(stored: Stored, step: int) -> DataFrame:
        return stored.df.withColumn("step", F.lit(step))

    repeated = Stored(shards(blocks.mapInPandas(first, ROWS), repeated_anchors), "repeated-anchors", packed=True)
    release(spark)
    told = with_blocks(at_step(repeated, 1), second, ROWS)
    classes = Stored(shards(told, lambda g: settle(g, many)), "cell-classes", packed=True)
    release(spark)
    before = at_step(repeated, 1).unionByName(at_step(classes, 2))
    found = Stored(with_blocks(before, third, ROWS), "covered", packed=True)
    release(spark)
    sent = found.df.where("bucket >= 0")
    covered = Stored(shards(sent.where(F.col("kind") == CELLS), lambda g: shard_suffixes(g, length)), "shard-covered", packed=True)
    windows = Stored(shards(sent.where(F.col("kind") == WINDOWS), lambda g: settle(g, 0)), "window-classes", packed=True)
    release(spark)
    again = windows.df.select("block").distinct()  # only these blocks need their classes once more
    told = (
        found.df.where("bucket < 0").withColumn("step", F.lit(3))
        .unionByName(at_step(covered, 3))
        .unionByName(at_step(windows, 4))
        .unionByName(before.join(again, "block", "left_semi"))
    )
    schema = "rid long, doc_id string, n_bytes long, kept binary, removed array<struct<start:long,end:long>>"
    return with_blocks(told, fourth, schema).withColumn("doc_id", F.col("doc_id").cast("long"))


def repeat_report(docs: DataFrame, **parameters) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(docs, **parameters).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
