"""Removal of long passages that occur more than once, with a family of anchor tables of geometric sizes.

Any 200 bytes contain an *anchor*: the place of the least hash among the hashes of their 169 runs of 32 bytes. It depends
on those bytes alone, so equal passages have equal anchors. A table keeps only the places of anchors, about one
in 85, each with the *stretch* of bytes around it that its 200-byte windows cover. Entries are ordered by the hash of the
first 32 bytes at the anchor, then by the hash of the stretch: places that share a long match are neighbours. Equality is that
of 64-bit hashes; bytes are not compared once more.

New documents form a batch with a table of its own. It is merged in order with all existing levels in one scan,
which finds the matches between them; levels of its size are replaced by one of double size, as in a binary counter.

* Entries whose whole stretch is equal match in all their windows, and one of them stands for all from then on.
* Entries that share the first 32 bytes but not the stretch match in some windows or none. Only their stretches are
  fetched, and their windows compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import kept

LENGTH = 200
GRAM = 32
# Window starts of one piece of a text. A task handles pieces of twice as many bytes at once, with some ten numbers of eight
# bytes for each place, which bounds its memory for very long texts; places fit into PLACE_BITS.
CHUNK = 1 << 19
PLACE_BITS = 24
# Entries that one task scans, stretches that one task compares, and the number of stretches from which the windows of
# one suffix are dealt out singly.
SCAN_ROWS, COMPARE_ROWS, HOT_SUFFIX = 400_000, 40_000, 20_000

_U = np.uint64
_GRAM_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], _U)
_WINDOW_MIX = (np.arange(1, 65, dtype=_U) * _U(0xBF58476D1CE4E5B9)) | _U(1)

ENTRY = "key long, stretch long, id long, th int, first int, last int, many boolean"
SPAN = "id long, th int, begin long, end long"


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    n = len(data) - 7
    out = np.empty(max(0, n), _U)
    for k in range(8):
        part = data[k : k + (max(0, n - k) + 7) // 8 * 8]
        part = part[: len(part) // 8 * 8].view("<u8")
        out[k::8] = part[: len(out[k::8])]
    return out


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    return x ^ (x >> _U(27))


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each place on."""
    n = len(words) - (GRAM - 8)
    mixed = _stir(words)
    total = mixed[:n] * _GRAM_MIX[0]
    for i in range(1, GRAM // 8):
        total += mixed[8 * i : 8 * i + n] * _GRAM_MIX[i]
    return _stir(total)


def window_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` bytes from each place on; ``length`` is a multiple of eight."""
    words = _stir(_words(data))
    n = len(data) - length + 1
    total = np.zeros(n, _U)
    for i in range(length // 8):
        total += words[8 * i : 8 * i + n] * _WINDOW_MIX[i]
    return _stir(total)


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def stretches(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the windows of concatenated texts that end at ``ends``: hash at the anchor, first and last window."""
    starts = np.concatenate([[0], ends[:-1]])
    width = length - GRAM + 1
    if len(data) < length:
        return tuple(np.array([], t) for t in (_U, np.int64, np.int64))
    hashes = gram_hashes(_words(data))
    low = _U((1 << PLACE_BITS) - 1)
    tagged = (hashes & ~low) | np.arange(len(hashes), dtype=_U)
    at = (_sliding_min(tagged, width) & low).astype(np.int64)
    inside = np.zeros(len(at) + 1, np.int64)
    room = ends - length + 1 > starts
    np.add.at(inside, starts[room], 1)
    np.add.at(inside, (ends - length + 1)[room], -1)
    window = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(window):
        return tuple(np.array([], t) for t in (_U, np.int64, np.int64))
    at = at[window]
    cut = np.flatnonzero(np.diff(at)) + 1
    first = np.concatenate([[0], cut])
    last = np.concatenate([cut, [len(at)]]) - 1
    return hashes[at[first]], window[first], window[last]


def _pieces(bodies: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of bounded size; the parts of a long text overlap by a window less one."""
    group, size = [], 0
    for k, body in enumerate(bodies):
        for at in range(0, max(1, len(body) - length + 1), CHUNK):
            part = body[at : at + CHUNK + length - 1]
            if len(part) < length:
                continue
            if group and size + len(part) > 2 * CHUNK:
                yield group
                group, size = [], 0
            group.append((k, at, part))
            size += len(part)
    if group:
        yield group


def _merged(owner: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Unions of the ranges of each owner."""
    order = np.lexsort((begin, owner))
    owner, begin, end = owner[order], begin[order], end[order]
    if not len(owner):
        return owner, begin, end
    lift = np.concatenate([[0], np.cumsum(np.diff(owner) != 0)]) * (int(end.max()) + 1)  # keeps owners apart
    reach = np.maximum.accumulate(end + lift)
    new = np.concatenate([[True], begin[1:] + lift[1:] > reach[:-1]])
    at = np.flatnonzero(new)
    stop = np.concatenate([at[1:], [len(owner)]]) - 1
    return owner[at], begin[at], (reach - lift)[stop]


def _rows(kind: str, **columns) -> pa.RecordBatch:
    names = ["kind", "key", "stretch", "id", "th", "first", "last", "many", "begin", "end"]
    types = dict(zip(names, [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(),
                             pa.bool_(), pa.int64(), pa.int64()], strict=True))
    n = len(next(iter(columns.values())))
    made = {"kind": pa.array([kind] * n, pa.string())} | {
        k: v if isinstance(v, pa.Array) else pa.array(v, types[k]) for k, v in columns.items()}
    return pa.RecordBatch.from_arrays([made.get(k, pa.nulls(n, types[k])) for k in names], names=names)


_OUT = f"kind string, {ENTRY}, begin long, end long"


def _anchor_table(length: int):
    """Entries of a batch of documents. Equal stretches of one task are matched here, before any shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, th = b.column("id"), b.column("th")
            bodies = [(t or "").encode("utf-8", "replace") for t in b.column("text").to_pylist()]
            keys, marks, owners, firsts, lasts = [], [], [], [], []
            for group in _pieces(bodies, length):
                data = b"".join(p for _, _, p in group)
                ends = np.cumsum([len(p) for _, _, p in group])
                key, first, last = stretches(np.frombuffer(data, np.uint8), ends, length)
                digest = xxhash.xxh3_64_intdigest
                marks.append(np.fromiter((digest(data[x : y + length]) for x, y in zip(first.tolist(), last.tolist(),
                                                                                      strict=True)), _U, len(first)))
                piece = np.searchsorted(ends, first, "right")
                shift = np.array([at for _, at, _ in group]) - np.concatenate([[0], ends[:-1]])
                owners.append(np.array([k for k, _, _ in group])[piece])
                firsts.append(first + shift[piece])
                lasts.append(last + shift[piece])
                keys.append(key)
            if not keys:
                continue
            key, mark, owner, first, last = map(np.concatenate, (keys, marks, owners, firsts, lasts))
            order = np.lexsort((mark, key))
            key, mark, owner, first, last = (x[order] for x in (key, mark, owner, first, last))
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (mark[1:] != mark[:-1])])
            group = np.cumsum(new) - 1
            many = np.bincount(group) > 1
            whole = many[group]
            who, begin, end = _merged(owner[whole], first[whole], last[whole] + length)
            yield _rows("span", id=ids.take(pa.array(who)), th=th.take(pa.array(who)), begin=begin, end=end)
            at = np.flatnonzero(new)
            yield _rows("entry", key=key[at].view(np.int64), stretch=mark[at].view(np.int64),
                        id=ids.take(pa.array(owner[at])), th=th.take(pa.array(owner[at])), first=first[at].astype(np.int32),
                        last=last[at].astype(np.int32), many=many)

    return run


def _scan(length: int):
    """Merge-scan of one range of the ordered entries of a new batch and all levels."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        col = {c: pa.concat_arrays([b.column(c) for b in parts]) for c in parts[0].schema.names}
        key, mark, first, last = (col[c].to_numpy(zero_copy_only=False) for c in ("key", "stretch", "first", "last"))
        many, level = (col[c].to_numpy(zero_copy_only=False) for c in ("many", "level"))
        new_key = np.concatenate([[True], key[1:] != key[:-1]])
        new = new_key | np.concatenate([[True], mark[1:] != mark[:-1]])
        group, suffix = np.cumsum(new) - 1, np.cumsum(new_key) - 1
        heads = np.flatnonzero(new)
        size = np.bincount(group)
        found = (size > 1) | (np.bincount(group, weights=many) > 0)
        # Single entries of a stretch that now has company match as a whole.
        here = np.flatnonzero((size[group] > 1) & ~many)
        yield _rows("span", id=col["id"].take(pa.array(here)), th=col["th"].take(pa.array(here)),
                    begin=first[here].astype(np.int64), end=last[here].astype(np.int64) + length)
        # Suffixes with several stretches, of which a new one; at the range's ends others may lie in the next range.
        fresh = np.bincount(suffix, weights=level < 0) > 0
        several = np.bincount(suffix[heads]) > 1
        wanted = several & fresh
        wanted[[0, -1]] = True
        pick = wanted[suffix[heads]]
        at = heads[pick]
        yield _rows("contest", key=key[at], id=col["id"].take(pa.array(at)), th=col["th"].take(pa.array(at)),
                    first=first[at], last=last[at], many=found[pick])
        # The level to come: one entry for each stretch of the runs that are merged.
        joining = np.flatnonzero(col["merge"].to_numpy(zero_copy_only=False))
        if len(joining):
            lead = joining[np.concatenate([[True], group[joining[1:]] != group[joining[:-1]]])]
            yield _rows("entry", key=key[lead], stretch=mark[lead], id=col["id"].take(pa.array(lead)),
                        th=col["th"].take(pa.array(lead)), first=first[lead], last=last[lead], many=found[group[lead]])

    return run


class RepeatIndex:
    """The family of levels. ``add`` takes new documents (columns id, th, text) and keeps what it finds in the shared
    folder; ``matches`` gives the ranges of all documents added so far that occur more than once."""

    def __init__(self, spark, length: int = LENGTH, scan_rows: int = SCAN_ROWS):
        if length % 8 or length < GRAM + 8:
            raise ValueError("the length must be a multiple of eight of at least 40")
        self.spark, self.length, self.scan_rows = spark, length, scan_rows
        self.levels: list[DataFrame | None] = []
        self.spans: list[DataFrame] = []
        self.contests: list[DataFrame] = []

    def add(self, docs: DataFrame) -> None:
        made = kept(docs.mapInArrow(_anchor_table(self.length), _OUT), "anchor-table")
        self.spans.append(made.where("kind = 'span'"))
        entries = [made.where("kind = 'entry'").withColumns({"level": F.lit(-1), "merge": F.lit(True)})]
        carry = 0
        while carry < len(self.levels) and self.levels[carry] is not None:
            carry += 1
        for k, level in enumerate(self.levels):
            if level is not None:
                entries.append(level.withColumns({"level": F.lit(k), "merge": F.lit(k < carry)}))
        columns = ["key", "stretch", "id", "th", "first", "last", "many", "level", "merge"]
        both = entries[0].select(columns)
        for more in entries[1:]:
            both = both.union(more.select(columns))
        ranges = max(1, -(-both.count() // self.scan_rows))
        ordered = both.repartitionByRange(ranges, "key", "stretch").sortWithinPartitions("key", "stretch", "level")
        done = kept(ordered.mapInArrow(_scan(self.length), _OUT), "anchor-level")
        self.spans.append(done.where("kind = 'span'"))
        self.contests.append(done.where("kind = 'contest'"))
        self.levels += [None] * (carry + 1 - len(self.levels))
        self.levels[:carry] = [None] * carry
        self.levels[carry] = done.where("kind = 'entry'")

    def matches(self, docs: DataFrame, compare_rows: int = COMPARE_ROWS, hot_suffix: int = HOT_SUFFIX) -> DataFrame:
        spans = self.spans[0]
        for more in self.spans[1:]:
            spans = spans.union(more)
        open_rows = self.contests[0]
        for more in self.contests[1:]:
            open_rows = open_rows.union(more)
        # An entry that several scans report is one occurrence.
        open_rows = open_rows.groupBy("key", "id", "th", "first", "last").agg(F.max("many").alias("many"))
        counts = open_rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        open_rows = kept(open_rows.join(counts, "key").withColumn("hot", F.col("n") > hot_suffix).drop("n"), "contests")
        lists = open_rows.groupBy("id", "th").agg(
            F.collect_list(F.struct("key", "first", "last", "many", "hot")).alias("open"))
        texts = docs.join(lists, docs["id"].eqNullSafe(lists["id"]) & (docs["th"] == lists["th"]), "inner").select(
            docs["id"], docs["th"], "text", "open")
        parts = kept(texts.mapInArrow(_fetched(self.length), "id long, th int, key long, first int, many boolean, "
                                      "hot boolean, body binary"), "stretches")
        some = parts.where("NOT hot")
        n = max(1, -(-some.count() // compare_rows))
        plain = some.repartition(n, "key").sortWithinPartitions("key").mapInArrow(_compared(self.length), SPAN)
        single = parts.where("hot").mapInArrow(_windows(self.length), "key long, w long, id long, th int, at long, many boolean")
        common = single.groupBy("key", "w").agg(F.count("*").alias("n"), F.max("many").alias("any")).where("n > 1 OR any")
        hot = single.where("NOT many").join(common.select("key", "w"), ["key", "w"], "left_semi").select(
            "id", "th", F.col("at").alias("begin"), (F.col("at") + self.length).alias("end"))
        return spans.select("id", "th", "begin", "end").union(plain).union(hot)


def _fetched(length: int):
    """The bytes of the stretches listed for each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "th", "key", "first", "many", "hot", "body"]
        for b in batches:
            ids, ths, bodies, lists = (b.column(c).to_pylist() for c in ("id", "th", "text", "open"))
            rows, size = [], 0
            for i, t, body, items in zip(ids, ths, bodies, lists, strict=True):
                data = (body or "").encode("utf-8", "replace")
                for x in items:
                    part = data[x["first"] : x["last"] + length]
                    rows.append((i, t, x["key"], x["first"], x["many"], x["hot"], part))
                    size += len(part)
                if size > CHUNK:
                    yield _batch(rows, names)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names)

    return run


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _hashed(b: pa.Table | pa.RecordBatch, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place within the row and hash of every window of the stretches."""
    bodies = b.column("body").to_pylist()
    sizes = np.array([len(x) for x in bodies])
    hashes = window_hashes(np.frombuffer(b"".join(bodies), np.uint8), length)
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(bodies)), windows)
    at = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    return row, at, hashes[np.repeat(np.cumsum(sizes) - sizes, windows) + at]


def _compared(length: int):
    def settle(table: pa.Table) -> pa.RecordBatch:
        row, at, hashes = _hashed(table, length)
        key = table.column("key").to_numpy().view(_U)
        many = table.column("many").to_numpy()
        mixed = _stir(hashes + key[row] * _U(0x9E3779B97F4A7C15))
        _, number, count = np.unique(mixed, return_inverse=True, return_counts=True)
        again = (count[number] > 1) & ~many[row]
        begin = table.column("first").to_numpy()[row[again]].astype(np.int64) + at[again]
        owner, begin, end = _merged(row[again], begin, begin + length)
        take = pa.array(owner)
        return pa.RecordBatch.from_arrays(
            [table.column("id").combine_chunks().take(take), table.column("th").combine_chunks().take(take),
             pa.array(begin, pa.int64()), pa.array(end, pa.int64())], names=["id", "th", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: pa.Table | None = None
        for b in batches:
            table = pa.Table.from_batches([b])
            waiting = table if waiting is None else pa.concat_tables([waiting, table])
            if waiting.num_rows < 10_000:
                continue
            key = waiting.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1], "left"))  # the last suffix may go on in the next batch
            if last:
                yield settle(waiting.slice(0, last))
                waiting = waiting.slice(last)
        if waiting is not None and waiting.num_rows:
            yield settle(waiting)

    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 2000):
                part = b.slice(start, 2000)
                row, at, hashes = _hashed(part, length)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(take), pa.array(hashes.view(np.int64)), part.column("id").take(take),
                     part.column("th").take(take), pa.array(part.column("first").to_numpy()[row].astype(np.int64) + at),
                     part.column("many").take(take)], names=["key", "w", "id", "th", "at", "many"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the ranges of each document; kept bytes, spans and counts."""
    for b in batches:
        out = []
        for body, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
            data = (body or "").encode("utf-8", "replace")
            parts, at, removed, runs = [], 0, 0, []
            for s in sorted((x["begin"], x["end"]) for x in spans or ()):
                if runs and s[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], s[1])
                else:
                    runs.append([*s])
            for begin, end in runs:
                parts.append(data[at:begin])
                removed += end - begin
                at = end
            parts.append(data[at:])
            out.append((len(data), removed, len(runs), b"".join(parts)))
        size, removed, runs, rest = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array([hashlib.sha256(x).hexdigest() for x in rest], pa.string()), pa.array(rest, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = LENGTH, batches: int = 4,
                   scan_rows: int = SCAN_ROWS, compare_rows: int = COMPARE_ROWS, hot_suffix: int = HOT_SUFFIX) -> DataFrame:
    """Per document: key, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept`` (bytes).

    Every byte covered by ``length`` bytes that also start anywhere else goes. Null and short texts lose nothing.
    Documents are told apart by key and a hash of the text; rows that repeat both count as two occurrences and get the
    same result. Columns other than key and text are not used.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.hash(text).alias("th"), F.col(text).alias("text"))
    index = RepeatIndex(docs.sparkSession, length, scan_rows)
    for k in range(batches):
        index.add(rows.where(F.pmod(F.hash("id"), F.lit(batches)) == k))
    spans = index.matches(rows.where(F.octet_length("text") >= length), compare_rows, hot_suffix)
    lists = spans.groupBy("id", "th").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    named = lists.select(F.col("id").alias("_id"), F.col("th").alias("_th"), "spans")
    whole = rows.join(named, rows["id"].eqNullSafe(named["_id"]) & (rows["th"] == named["_th"]), "left").select(
        "id", "text", "spans")
    return whole.mapInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                            "kept binary").withColumnRenamed("id", key)


def op9_repeats(spark, docs: DataFrame) -> DataFrame:
    """Every document's bytes that repeat, counted, and a digest of the others. Null and empty texts have no bytes, rows that
    repeat a whole text of 200 bytes lose all of it, an empty table gives no rows, and columns but doc_id and text are ignored."""
    return remove_repeats(docs.select("doc_id", "text")).drop("kept")
