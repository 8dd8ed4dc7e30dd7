"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a ``length``-byte string that covers it also starts earlier (smaller id, or same document and
smaller start), that is, when the longest previous factor at some start is ``length`` or more.

Suffixes are only sorted where a match can be:

1. Each window of ``length`` bytes has an anchor, the leftmost smallest hash of the ``GRAM``-byte strings in it. Equal
   windows have equal anchors at equal places, so windows can only match inside one anchor's group. An anchor's unit is
   all bytes of the windows that may own it (at most ``2 * length - GRAM``).
2. Units sorted by anchor and content: of equal units all but the first are repeated throughout. This settles copies and
   the inside of shared passages. Most anchors occur once and are dropped here.
3. What is left, different units of one anchor, gets a suffix array by prefix doubling, cut off at ``length`` bytes, the
   common prefixes of its neighbours, and for each start the nearest entries of smaller place before and after it; the
   larger of the two common prefixes is the start's longest previous factor. Anchors with more than ``HOT`` different
   units are not gathered in a task: each of their windows is a row and the smallest position per window is an aggregate.

Step 1 hashes (64 bits) only propose groups and equal units; step 3 compares bytes.

Defined results: a null text counts as empty. A row with a null id comes after all others. Rows that repeat both id and
text are one document; rows that share only the id are ordered by a hash of the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, same_key, settled
from .words import TABLE, U, mix, text_steps

LENGTH, GRAM = 100, 32
#: Units sorted together, and different units of one anchor from which its windows become rows.
CHUNK, HOT = 4000, 20_000
#: Bytes of one document looked at together; pieces overlap by ``LENGTH - 1`` bytes.
PIECE = 1 << 25
_FACTOR = 0x9E3779B97F4A7C15
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_tables[0]) < n:
        for i, f in enumerate((_FACTOR, pow(_FACTOR, -1, 1 << 64))):
            _tables[i] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, U(f))]), dtype=np.uint64)
    return _tables


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by block-wise running minima from both sides."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(document, place, bytes before, bytes after, anchor hash, unit hash)`` of all anchors, as arrays."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    up, down = _power_tables(n + 1)
    summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE[data] * up[:n], dtype=np.uint64)])
    grams = mix((summed[gram:] - summed[:-gram]) * down[:n - gram + 1])
    bits = U(26)
    place = np.arange(len(grams), dtype=np.uint64)
    best = sliding_min((grams >> bits << bits) | place, length - gram + 1)
    sizes = np.diff(offsets)
    starts = np.arange(len(best))
    stop = np.repeat(offsets[1:], sizes)[:len(best)]
    at = (best[starts + length <= stop] & U((1 << 26) - 1)).astype(np.int64)
    if not len(at):
        return none, none, none, none, none.view(np.uint64), none.view(np.uint64)
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    doc = np.searchsorted(offsets, at, side="right") - 1
    first, last = np.maximum(offsets[doc], at - (length - gram)), np.minimum(offsets[doc + 1], at + length)
    before, after = at - first, last - at
    unit = mix((summed[last] - summed[first]) * down[first] ^ mix((before << 8 | after).astype(np.uint64)))
    return doc, at - offsets[doc], before, after, grams[at], unit


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """Steps of at most about ``PIECE`` bytes; a longer document comes as overlapping pieces with their shift."""
    if len(data) <= PIECE:
        yield data, offsets, 0
    else:
        for shift in range(0, len(data) - length + 1, PIECE - length + 1):
            part = data[shift:shift + PIECE]
            yield part, np.array([0, len(part)]), shift


def slots(tag: np.ndarray, at: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One sortable number: tag (16 bits), place (32), bytes before (7) and after (8)."""
    return tag << 47 | at << 15 | before << 8 | after


def place_of(slot):
    return slot >> 15 & 0xFFFFFFFF


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc`` (null ids last), ``tag`` (a short hash that tells texts of one id apart), ``text``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    return docs.select(doc.alias("doc"), F.pmod(F.xxhash64(text), F.lit(65536)).cast("long").alias("tag"), text.alias("text"), F.col(id_col).cast("long").alias("doc_id"))


def later_copies(anchor: np.ndarray, unit: np.ndarray, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Whether a row's unit comes earlier among these rows (other than the same row again)."""
    order = np.lexsort((slot, doc, unit, anchor))
    anchor, unit, doc, slot = anchor[order], unit[order], doc[order], slot[order]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (unit[1:] != unit[:-1])])
    head = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    out = np.zeros(len(order), bool)
    out[order] = (doc != doc[head]) | (slot != slot[head])
    return out


def anchor_rows(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``deal, sure, anchor, unit, doc, slot`` of all anchors.

    A unit that comes earlier in the same batch of documents is repeated for sure, whatever the rest of the table holds.
    Such rows are dealt out by their own place instead of their anchor, so of a very common passage only one row per
    batch and content meets in one task.
    """
    def step(batch: pa.RecordBatch):
        ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        parts = []
        for a, _, data, offsets in text_steps(batch.column(2)):
            for part, bounds, shift in pieces_of(data, offsets, length):
                doc, at, before, after, anchor, unit = anchors(part, bounds, length, gram)
                parts.append((anchor.view(np.int64), unit.view(np.int64), ids[a + doc], slots(tags[a + doc], at + shift, before, after)))
        if not parts:
            return
        anchor, unit, doc, slot = (np.concatenate(c) for c in zip(*parts))
        sure = later_copies(anchor, unit, doc, slot) if len(anchor) else np.zeros(0, bool)
        deal = np.where(sure, mix((doc ^ slot).astype(np.uint64)).view(np.int64), anchor)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (deal, sure, anchor, unit, doc, slot)], ["deal", "sure", "anchor", "unit", "doc", "slot"])

    return map_batches(rows.select("doc", "tag", "text"), step, "deal long, sure boolean, anchor long, unit long, doc long, slot long")


def settle_equal_units(found: DataFrame) -> DataFrame:
    """Rows ``open, doc, slot, anchor``: units equal to an earlier one (open false), and the first of each content where
    its anchor has several (open true). Walks sorted rows and remembers one row only."""

    def run(batches):
        last, pending, start = None, None, (0, 0)  # last row, first row of an anchor with one content so far, unit's first
        for batch in batches:
            sure = batch.column(0).to_numpy(zero_copy_only=False)
            anchor, unit, doc, slot = (c.to_numpy() for c in batch.columns[1:])
            if sure.any():  # these come after all others
                done = [x[sure] for x in (doc, slot, anchor)]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(done[0]), bool)), *map(pa.array, done)], names)
                anchor, unit, doc, slot = (x[~sure] for x in (anchor, unit, doc, slot))
            if not len(anchor):
                continue
            new_anchor = np.concatenate([[last is None or anchor[0] != last[0]], anchor[1:] != anchor[:-1]])
            new_unit = new_anchor | np.concatenate([[last is None or unit[0] != last[1]], unit[1:] != unit[:-1]])
            run_of = np.cumsum(new_anchor) - (1 if new_anchor[0] else 0)  # 0: the run that was going on, if any
            contents = np.bincount(run_of, new_unit, run_of[-1] + 1)
            several = contents > 1
            if not new_anchor[0]:
                several[0] = contents[0] > 0 or pending is None
            is_open = new_unit & (several[run_of] | ~new_anchor)
            # a row that repeats the first of its unit in id and place is the same document
            head = np.maximum.accumulate(np.where(new_unit, np.arange(len(unit)), -1))
            first_doc, first_slot = np.where(head < 0, start[0], doc[head]), np.where(head < 0, start[1], slot[head])
            start = (first_doc[-1], first_slot[-1])
            keep = is_open | (~new_unit & ((doc != first_doc) | (slot != first_slot)))
            out = [is_open[keep], doc[keep], slot[keep], anchor[keep]]
            if not new_anchor[0] and contents[0] > 0 and pending is not None:
                out = [np.concatenate([[x], y]) for x, y in zip((True, *pending), out)]
                pending = None
            if new_anchor.any():
                k = int(np.flatnonzero(new_anchor)[-1])
                pending = (doc[k], slot[k], anchor[k]) if not several[run_of[k]] else None
            last = (anchor[-1], unit[-1])
            yield pa.RecordBatch.from_arrays([pa.array(out[0].astype(bool)), *(pa.array(x.astype(np.int64)) for x in out[1:])], names)

    names = ["open", "doc", "slot", "anchor"]
    ordered = found.repartition("deal").drop("deal").sortWithinPartitions("sure", "anchor", "unit", "doc", "slot")
    return ordered.mapInArrow(run, "open boolean, doc long, slot long, anchor long")


def suffix_names(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """Prefix doubling, cut off at ``length``: for widths 8, 16, .. the rank of every start by its first so many bytes."""
    words = np.zeros(len(data) - 8, np.uint64)
    for k in range(8):
        words = words << U(8) | data[k:k + len(words)]
    width = 8
    names = {width: np.unique(words, return_inverse=True)[1].astype(np.int64)}
    while 2 * width <= length:
        rank = names[width]
        pair = rank[:-width] * (int(rank.max()) + 1) + rank[width:]
        names[2 * width] = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return names


def neighbour_lcp(data: np.ndarray, names: dict[int, np.ndarray], suffixes: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the array (0 for the first), counted to ``length``."""
    one, two = suffixes[:-1], suffixes[1:]
    common = np.zeros(len(one), np.int64)
    for width in sorted(names, reverse=True):
        common += width * (names[width][one + common] == names[width][two + common])
    going = np.ones(len(one), bool)
    for _ in range(7):
        going &= data[one + common] == data[two + common]
        common += going
    return np.concatenate([[0], np.minimum(common, length)])[:len(suffixes)]


def smaller_before(place: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry of a suffix array the nearest earlier entry of smaller place (-1: none), and their common prefix.

    The stack pass, all entries at once: an entry jumps from a candidate that is not smaller to that one's own candidate,
    everything between being larger still, and keeps the least common prefix on the way.
    """
    n = len(place)
    at, low = np.arange(n) - 1, lcp.copy()
    going = np.arange(1, n)
    while len(going):
        going = going[(at[going] >= 0)]
        going = going[place[at[going]] >= place[going]]
        via = at[going]
        at[going], low[going] = at[via], np.minimum(low[going], low[via])
    low[at < 0] = 0
    return at, low


def longest_previous_factors(data: np.ndarray, starts: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """The longest-previous-factor array of ``starts``: how many bytes from each start, counted to ``length``, also begin at a
    start of smaller ``place``. Every start has ``length`` bytes of its own; entries of equal place are one start seen twice.

    In suffix order the longest earlier factor of a start is the one it shares with the nearest entry of smaller place before
    it or after it.
    """
    if not len(starts):
        return np.zeros(0, np.int64)
    names = suffix_names(data, length)
    width = max(names)
    rank = names[width]
    order = np.lexsort((place, rank[starts + length - width], rank[starts]))
    lcp = neighbour_lcp(data, names, starts[order], length)
    _, before = smaller_before(place[order], lcp)
    # from the other end: the common prefix with the next entry is that entry's own
    _, after = smaller_before(place[order][::-1], np.concatenate([[0], lcp[:0:-1]]))
    out = np.empty(len(starts), np.int64)
    out[order] = np.maximum(before, after[::-1])
    return out


def repeated_starts(units: list[bytes], doc: np.ndarray, start: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """``(unit number, start in the document)`` of every start whose longest previous factor has ``length`` bytes.

    ``doc`` and ``start`` give the document order and the place of each unit's first byte.
    """
    if length < 8:
        raise ValueError("length must be at least 8")
    sizes = np.array([len(u) for u in units])
    data = np.frombuffer(b"".join(units) + bytes(2 * length + 16), np.uint8)
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(units)), sizes)
    inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.flatnonzero(inside + length <= sizes[owner])
    unit = owner[whole]
    at = start[unit] + inside[whole]
    by_place = np.lexsort((at, doc[unit]))
    new = np.ones(len(whole), bool)
    new[1:] = (doc[unit][by_place][1:] != doc[unit][by_place][:-1]) | (at[by_place][1:] != at[by_place][:-1])
    place = np.empty(len(whole), np.int64)
    place[by_place] = np.cumsum(new)
    earlier = longest_previous_factors(data, whole, place, length) >= length
    return unit[earlier], at[earlier]


def joined_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of overlapping or touching intervals."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([new[1:], [True]])]


def compare_units(units: DataFrame, length: int, chunk: int) -> DataFrame:
    """``doc, tag, first, last`` of repeated stretches among ``anchor, doc, slot, bytes``; all units of an anchor meet."""

    def settle(rows: list) -> pa.RecordBatch:
        rows = list({(r[1], r[2]): r for r in rows}.values())  # a repeated row brings its units twice
        doc, slot = np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64)
        # texts of one id are told apart by the tag
        order = np.unique(np.stack([doc, slot >> 47], 1), axis=0, return_inverse=True)[1].ravel()
        unit, at = repeated_starts([r[3] for r in rows], order, place_of(slot) - (slot >> 8 & 0x7F), length)
        parts = []
        by_unit = np.lexsort((at, unit))
        unit, at = unit[by_unit], at[by_unit]
        cut = np.flatnonzero(np.concatenate([[True], (unit[1:] != unit[:-1]) | (at[1:] > at[:-1] + 1)])) if len(unit) else []
        ends = np.append(cut[1:], len(unit)) - 1 if len(unit) else []
        for a, b in zip(cut, ends):
            parts.append((doc[unit[a]], slot[unit[a]] >> 47, at[a], at[b] + length))
        return pa.RecordBatch.from_arrays([pa.array([int(p[i]) for p in parts], pa.int64()) for i in range(4)], ["doc", "tag", "first", "last"])

    def run(batches):
        rows, last = [], None
        for batch in batches:
            for anchor, doc, slot, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if anchor != last and len(rows) >= chunk:
                    yield settle(rows)
                    rows = []
                last = anchor
                rows.append((anchor, doc, slot, raw))
        if rows:
            yield settle(rows)

    return units.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc long, tag long, first long, last long")


def compare_windows(units: DataFrame, length: int) -> DataFrame:
    """As ``compare_units`` for hot anchors: one row per window; the smallest position per window stays."""

    def step(batch: pa.RecordBatch):
        for doc, slot, raw in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3))):
            first = int(place_of(slot)) - (slot >> 8 & 0x7F)
            n = len(raw) - length + 1
            yield pa.RecordBatch.from_arrays([
                pa.array([hashlib.blake2b(raw[i:i + length], digest_size=16).digest() for i in range(n)], pa.binary()),
                pa.array([doc] * n, pa.int64()), pa.array([slot >> 47] * n, pa.int64()), pa.array(range(first, first + n), pa.int64()),
            ], ["window", "doc", "tag", "first"])

    windows = settled(map_batches(units, step, "window binary, doc long, tag long, first long").distinct(), "windows")
    least = windows.groupBy(F.col("window").alias("known")).agg(F.min(F.struct("doc", "tag", "first")).alias("least"))
    later = windows.join(least, same_key("window", "known", "windows")).filter(F.struct("doc", "tag", "first") > F.col("least"))
    return later.select("doc", "tag", "first", (F.col("first") + length).alias("last"))


def repeated_stretches(rows: DataFrame, length: int, gram: int, chunk: int, hot: int) -> DataFrame:
    """``doc, tag, first, last``: stretches (not yet joined) whose bytes all go."""
    found = settled(settle_equal_units(anchor_rows(rows, length, gram)), "units")
    place, slot = F.expr("shiftright(slot, 15) & 4294967295"), F.col("slot")
    tag = F.shiftright(slot, 47).alias("tag")
    equal = found.filter("NOT open").select(
        "doc", tag, (place - (F.shiftright(slot, 8).bitwiseAND(F.lit(127)))).alias("first"), (place + slot.bitwiseAND(F.lit(255))).alias("last"),
    )
    still = found.filter("open")
    many = still.groupBy(F.col("anchor").alias("hot")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("hot")
    still = still.join(settled(many, "hot"), same_key("anchor", "hot", "hot"), "left")
    wanted = still.groupBy(F.col("doc").alias("d"), tag.alias("t")).agg(F.collect_list(F.struct("slot", "anchor", F.col("hot").isNotNull().alias("hot"))).alias("wanted"))
    with_text = rows.join(wanted, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], [], []]
        for doc, text, places in zip(*batch.columns):
            doc, raw = doc.as_py(), text.as_py().encode()
            for w in places.as_py():
                at = int(place_of(w["slot"]))
                unit = raw[at - (w["slot"] >> 8 & 0x7F):at + (w["slot"] & 0xFF)]
                for column, value in zip(out, (w["anchor"], doc, w["slot"], unit, w["hot"])):
                    column.append(value)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["anchor", "doc", "slot", "bytes", "hot"])

    schema = "anchor long, doc long, slot long, bytes binary, hot boolean"
    units = settled(map_batches(with_text.select("doc", "text", "wanted"), cut, schema), "unit-bytes")
    usual = compare_units(units.filter("NOT hot").drop("hot"), length, chunk)
    return equal.unionByName(usual).unionByName(compare_windows(units.filter("hot").drop("hot"), length))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK, hot: int = HOT, id_col: str = "doc_id",
    text_col: str = "text", with_bytes: bool = False,
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row (and ``kept``, the bytes left)."""
    rows = identified(docs, id_col, text_col)
    gone = settled(repeated_stretches(rows, length, gram, chunk, hot), "stretches")
    per = gone.groupBy(F.col("doc").alias("d"), F.col("tag").alias("t")).agg(
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"),
    )
    joined = rows.join(per, (F.col("doc") == F.col("d")) & (F.col("tag") == F.col("t")), "left").select("doc_id", "text", "firsts", "lasts")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], [], [], []]
        for text, firsts, lasts in zip(*batch.columns[1:]):
            raw = text.as_py().encode()
            starts, ends = (joined_runs(firsts.values.to_numpy(), lasts.values.to_numpy()) if firsts.is_valid else ([], []))
            left, at = [], 0
            for a, b in zip(starts, ends):
                left.append(raw[at:a])
                at = b
            left = b"".join([*left, raw[at:]])
            for column, value in zip(out, (len(raw), len(raw) - len(left), len(starts), hashlib.sha256(left).hexdigest(), left)):
                column.append(value)
        arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_bytes:
            arrays, names = [*arrays, pa.array(out[4], pa.binary())], [*names, "kept"]
        return pa.RecordBatch.from_arrays(arrays, names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return map_batches(joined, step, schema + (", kept binary" if with_bytes else ""))
