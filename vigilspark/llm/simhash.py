"""Near-duplicates by SimHash: fingerprints, and a self-join of binary tries within a Hamming budget."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Forest, kept, settled, with_columns
from .components import components

BITS, SEED = 64, 42
# A bucket of more distinct fingerprints than this is dealt out again by a second equal band.
BUCKET = 50_000
# Node pairs that one step of a trie join handles at once, and leaf pairs up to which two nodes are compared directly.
STEP, LEAVES = 20_000, 64


def fingerprint(text: str | None, words_per_shingle: int) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; a text without words has fingerprint 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - words_per_shingle + 1)
    last = min(words_per_shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in zip(starts[:n], ends[last:], strict=True)),
                         np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):  # bounded memory for very long texts
        ones += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, *, text: str = "text", words_per_shingle: int = 3, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long, bit 63 first."""
    def make():
        def work(texts):
            made = np.array([fingerprint(t, words_per_shingle) for t in texts], np.uint64)
            return [pa.array(made.view(np.int64))]
        return work

    return with_columns(docs, text, [T.StructField(name, T.LongType())], make)


def trie_links(keys: np.ndarray, budget: int, bits: int = BITS, fixed: int = 0) -> np.ndarray:
    """For sorted distinct ``keys``, the index of a representative each is linked to through differences of at most
    ``budget`` bits, none of them among the first ``fixed`` bits.

    The sorted array is a binary trie: a node is a range of indices and its children are the parts with the next bit 0
    and 1. Pairs of nodes are walked down together with the number of bits that already differ, and dropped beyond the
    budget. Pairs whose leaves are all known to hang together are dropped too, so a dense group costs no walk over all
    its pairs, and what is kept is one representative per key.
    """
    n = len(keys)
    forest = Forest(n)
    if n < 2:
        return forest.roots()
    zeros = np.zeros((bits, n + 1), np.int64)
    for d in range(bits):
        np.cumsum((keys >> np.uint64(bits - 1 - d)) & np.uint64(1) == 0, out=zeros[d, 1:])
    stack = [(0, np.array([[0], [n], [0], [n], [0]]))]  # depth; rows: range a, range b, differing bits
    while stack:
        depth, p = stack.pop()
        if p.shape[1] > STEP:
            stack += [(depth, p[:, STEP:]), (depth, p[:, :STEP])]
            continue
        p = p[:, (p[0] != p[2]) | (p[1] - p[0] > 1)]
        if p.shape[1]:
            top = forest.roots()
            ends = np.append(np.flatnonzero(top[1:] != top[:-1]) + 1, n)  # where runs of one part end
            whole = ends[np.searchsorted(ends, p[0], "right")] >= p[1]
            whole &= ends[np.searchsorted(ends, p[2], "right")] >= p[3]
            p = p[:, ~(whole & (top[p[0]] == top[p[2]]))]
        # Small pairs of nodes are compared leaf by leaf; this also decides all that have come down to the last bit.
        size_b = p[3] - p[2]
        size = (p[1] - p[0]) * size_b
        small = size <= LEAVES
        if small.any():
            q, size, size_b = p[:, small], size[small], size_b[small]
            pair = np.repeat(np.arange(q.shape[1]), size)
            nth = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
            a, b = q[0][pair] + nth // size_b[pair], q[2][pair] + nth % size_b[pair]
            unlike = keys[a] ^ keys[b]
            near = (np.bitwise_count(unlike) <= budget) & (a < b)
            if fixed:
                near &= unlike >> np.uint64(bits - fixed) == 0
            forest.join(a[near], b[near])
            p = p[:, ~small]
        if not p.shape[1]:
            continue
        z = zeros[depth]
        mid_a, mid_b = p[0] + z[p[1]] - z[p[0]], p[2] + z[p[3]] - z[p[2]]
        own = p[0] == p[2]
        next_pairs = [np.array([p[0], mid_a, p[2], mid_b, p[4]]), np.array([mid_a, p[1], mid_b, p[3], p[4]])]
        if depth >= fixed:
            next_pairs += [np.array([p[0], mid_a, mid_b, p[3], p[4] + 1]),
                           np.array([mid_a, p[1], p[2], mid_b, p[4] + 1])[:, ~own]]
        q = np.concatenate(next_pairs, axis=1)
        q = q[:, (q[0] < q[1]) & (q[2] < q[3]) & (q[4] <= budget)]
        if q.shape[1]:
            stack.append((depth + 1, q))
    return forest.roots()


def _rotated(fp: np.ndarray, band: int, width: int) -> np.ndarray:
    """The fingerprints with a band of bits moved to the front."""
    shift = np.uint64(band * width)
    if not band:
        return fp
    return (fp << shift) | (fp >> np.uint64(BITS - band * width))


def _links(bands: int, budget: int):
    width = BITS // bands

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column("band").to_numpy(), b.column("fp").to_numpy().view(np.uint64)) for b in batches]
        if not rows:
            return
        band, fp = (np.concatenate(x) for x in zip(*rows, strict=True))
        for k in np.unique(band):
            keys = np.unique(_rotated(fp[band == k], int(k) % bands, width))
            top = trie_links(keys, budget, fixed=width)
            own = np.arange(len(keys)) != top
            back = (bands - int(k) % bands) % bands
            a, b = _rotated(keys[own], back, width), _rotated(keys[top[own]], back, width)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return run


def links(prints: DataFrame, *, budget: int = 3, bucket: int = BUCKET) -> DataFrame:
    """Pairs ``a``, ``b`` of distinct fingerprints (column ``fp``) that connect all within ``budget`` bits of each other.

    Fingerprints that differ in at most ``budget`` bits agree on one of ``budget + 1`` bands, so those of one band value
    meet in one task, where a trie join over the whole task finds what hangs together. A band value with more than
    ``bucket`` fingerprints is split by the same argument among the other bits, exactly. A task returns fewer pairs than
    it has fingerprints.
    """
    bands = budget + 1
    width = BITS // bands
    if width * bands != BITS:
        raise ValueError("budget + 1 must divide 64")
    mask = (1 << width) - 1
    one = prints.select("fp").distinct()
    keyed = one.select("fp", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).withColumn(
        "value", F.shiftrightunsigned(F.expr(f"shiftleft(fp, band * {width})"), BITS - width))
    hot = keyed.groupBy("band", "value").count().where(F.col("count") > bucket).select("band", "value", F.lit(1).alias("hot"))
    dealt = keyed.join(hot, ["band", "value"], "left")
    # The second band of a hot bucket: each other band is cut into ``bands`` parts, and one part of all of them together
    # is equal wherever at most ``budget`` bits differ.
    part = width // bands
    second = "".join(f"{'' if i == 0 else ','} shiftright(shiftleft(fp, ((band + {i + 1}) % {bands}) * {width} + sub * {part}),"
                     f" {BITS - part}) & {(1 << part) - 1}" for i in range(bands - 1))
    dealt = dealt.withColumn("sub", F.explode(F.when(F.col("hot") == 1, F.sequence(F.lit(0), F.lit(bands - 1))).otherwise(
        F.array(F.lit(-1))))).withColumn(
        "inner", F.when(F.col("sub") < 0, F.lit(0).cast("long")).otherwise(F.expr(f"xxhash64(sub, {second})")))
    return dealt.select("fp", "band", "value", "inner").repartition("band", "value", "inner").select(
        "band", "fp").mapInArrow(_links(bands, budget), "a long, b long")


def near_groups(prints: DataFrame, key: str, *, budget: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``key``, ``fp`` and ``component_id``, the smallest key of the rows whose fingerprints hang together.

    Rows with equal fingerprints are one node. A null key counts as the largest, and gives null only to groups without
    any other. ``prints`` is read several times, so it should be stored.
    """
    least = prints.groupBy("fp").agg(F.min(key).alias("least"))
    parts = components(links(prints, budget=budget, bucket=bucket))
    # A component's smallest key: few rows per fingerprint, one per fingerprint after the grouping above.
    linked = parts.join(least, F.col("node") == F.col("fp"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = parts.join(smallest, "component").select(F.col("node").alias("fp"), F.col("component_id").alias("linked"))
    ids = settled(least.join(named, "fp", "left").select("fp", F.coalesce("linked", "least").alias("component_id")))
    return prints.join(ids, "fp").select(key, "fp", "component_id")


def op5_simhash(spark, docs: DataFrame) -> DataFrame:
    """Null, empty and blank texts have fingerprint zero and link like any other."""
    prints = kept(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "simhash")
    found = near_groups(prints, "doc_id")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
