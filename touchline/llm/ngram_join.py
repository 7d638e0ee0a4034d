"""Jaccard self-join on word shingles with token-combination prefixes.

A document is the set of its word n-grams. If two sets are similar enough, each misses at
most ``n - t`` tokens of the other (``t`` = smallest overlap that its size ``n`` allows), so
when tokens are put in one global order, the first ``n - t + 1`` tokens of both must
meet. Order and index follow the token's class:

* rare tokens come first. A token that was counted and found in one set alone fills a place
  of the prefix, and needs no posting, for no other set can meet it there;
* frequent tokens come after them, and very frequent ones after those, so that a passage
  found in many texts is hardly ever in a prefix. Both are dealt into a number of classes
  that grows with the size of the set. Of each class *pairs* are indexed, and the
  prefix is extended by one token for each class it touches, so that a similar pair
  still shares a signature. Of very small sets they are indexed one by one;
* tokens of which the frequency was not counted come last, one by one.

Frequencies are counted over all sets, for all tokens with a hash below a cut, about half
as many again as a prefix needs; so which tokens are counted is the same for all sets. Such a token is frequent if two different sets have it
(or its bit in a bounded bit map is set by one that is), and very frequent from ``OFTEN`` sets on. Which tokens are
called frequent decides the work and never the result. Sets whose signatures meet form
groups; chance meetings chain unlike sets together there, the more so the larger the corpus. So the
pairs of a group are first compared by sketches, parities of the numbers of tokens that end in the same bits: two sets differ
by at least as many tokens as their sketches differ by bits. What may link by sizes and sketches
forms candidate groups, and all their pairs are verified against whole sets. Both run in blocks of
bounded size and of neighbouring set sizes. A block hands on a spanning forest of its
links instead of all pairs, so a group of many copies costs rows in proportion to its
members.

Tokens and signatures travel packed, by ranges: a few bytes each, one row a range and task. Meetings are handed on as stars, first
within a task and then within a range.

Of equal texts one row is counted and signed; equal sets are one set. Sets are sets of 64-bit hashes.

Nulls and edges: a null or empty text has no shingles and links with nothing; a row
without ``doc_id`` is returned with a null component and takes no part; repeated rows are
returned as often as given; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm import arrays
from touchline.llm.shared import bit_map, components, in_map, stored, text_key

#: Bits of the maps of frequent tokens, first copies and candidate rows: 8 MB each. More
#: bits call fewer rare tokens frequent in a large corpus; they decide the work only.
MAP_BITS = 26
#: Ranges that tokens are dealt into, as bits; bytes of a token that are kept there (fewer make chance meetings, which are
#: work only); tokens that a task holds before it deals them out.
RANGE_BITS = 8
KEPT_BYTES = 5
HELD = 1 << 21
#: Bits of the longest sketch of a set.
SKETCH_BITS = 1 << 15
#: Shingles and sets in one block of a candidate group.
BLOCK_SHINGLES = 1 << 20
BLOCK_SETS = 1024
#: Tokens of a class in a prefix, at least about; less than twice as many at most.
CLASS_TOKENS = 2
#: Sets of fewer tokens have their frequent ones indexed one by one.
SMALL = 16
#: Sets that have a very frequent token.
OFTEN = 32
#: Tokens in fewer sets of a block than this are counted pair by pair, others by matrix product.
DENSE = 32


def shingle_sets(chunk: arrays.Chunk, k: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text of a chunk."""
    data = chunk.lowered()
    found = arrays.words(data, chunk.bounds, arrays.NOT_SPACE)
    hashed = arrays.hashes(data, found)
    made = arrays.grams(hashed, k)
    for low, high in pairwise(found.bounds.tolist()):
        if high - low >= k:
            yield np.unique(made[low : high - k + 1])
        elif high > low:
            yield arrays.grams(hashed[low:high], high - low)
        else:
            yield hashed[:0]


def set_key(tokens: np.ndarray) -> int:
    """A hash of the whole set; 0 for the empty one."""
    return int(arrays.mix(tokens ^ np.uint64(len(tokens))).sum(dtype=np.uint64).view(np.int64)) if len(tokens) else 0


class Threshold:
    """Sizes that follow from ``intersection / union >= num / den``."""

    def __init__(self, num: int, den: int) -> None:
        if not 3 * num >= 2 * den:
            raise ValueError("the similarity must be two thirds or more")
        self.num, self.den = num, den
        low, self.lows = 1, []
        while low < 1 << 40:
            self.lows.append(low)
            low = low * den // num + 1

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    @property
    def cut(self) -> np.uint64:
        """Hashes below are counted: about half as many again as the prefix of a set needs."""
        return np.uint64(min((1 << 64) - 1, (1 << 63) * 3 * (self.den - self.num) // self.den))

    def band(self, n: int) -> int:
        """Linked sets are in the same or in neighbouring bands."""
        return int(np.searchsorted(self.lows, n, side="right")) - 1

    def classes(self, band: int) -> int:
        """Classes that frequent tokens are dealt into: a power of two, so that neighbouring bands mostly agree; 0 for none."""
        low = self.lows[band]
        return 0 if low < SMALL else 1 << (max(1, self.prefix(low) // CLASS_TOKENS).bit_length() - 1)


def signatures(tokens: np.ndarray, frequent: np.ndarray, often: np.ndarray, rule: Threshold) -> np.ndarray:
    """Hashes to index a sorted set by; ``frequent`` and ``often`` tell which tokens are frequent, and very frequent."""
    if not len(tokens):
        return tokens
    need, own = rule.prefix(len(tokens)), rule.band(len(tokens))
    known = int(np.searchsorted(tokens, rule.cut))
    low, rest = tokens[:known], tokens[known:]
    frequent, often = frequent[:known], often[:known]
    need -= min(need, int((~frequent).sum()))
    if not need:
        return tokens[:0]
    common = np.concatenate([low[frequent & ~often], low[frequent & often]])
    very = np.arange(len(common)) >= (frequent & ~often).sum()
    out = []
    # A partner's band is this one, the one above or the one below.
    for classes in sorted({rule.classes(own), rule.classes(own + 1)}):
        salt = np.uint64(classes)
        if not classes:
            kept = common[:need]
            out.append(arrays.mix(kept + salt))
            gained = len(kept)
        else:
            label = arrays.mix(common ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(classes)
            label = label * np.uint64(2) + very
            again = np.ones(len(common), dtype=bool)
            again[np.unique(label, return_index=True)[1]] = False
            gains = np.cumsum(again)
            enough = np.searchsorted(gains, need) + 1
            kept, label = common[:enough], label[:enough]
            gained = int(gains[min(enough, len(gains)) - 1]) if len(gains) else 0
            order = np.argsort(label, kind="stable")
            for group in np.split(kept[order], np.flatnonzero(np.diff(label[order].view(np.int64))) + 1):
                i, j = np.triu_indices(len(group), 1)
                out.append(arrays.mix(group[i] * np.uint64(0x9E3779B97F4A7C15) + group[j] + salt))
        out.append(rest[: max(0, need - gained)])
    return np.unique(np.concatenate(out))


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _dealt(tokens: np.ndarray, labels: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """For each label, the packed tokens (low ``KEPT_BYTES`` bytes) and further columns of its rows."""
    order = np.argsort(labels, kind="stable")
    labels = labels[order]
    tokens = tokens[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES]
    columns = [x[order] for x in columns]
    starts = np.flatnonzero(np.diff(labels, prepend=-1))
    for low, high in pairwise([*starts.tolist(), len(labels)]):
        yield int(labels[low]), [np.ascontiguousarray(tokens[low:high]).tobytes(), *(x[low:high].tobytes() for x in columns)]


def _tokens(parts: pa.ChunkedArray) -> np.ndarray:
    packed = np.frombuffer(b"".join(parts.to_pylist()), dtype=np.uint8).reshape(-1, KEPT_BYTES)
    out = np.zeros((len(packed), 8), dtype=np.uint8)
    out[:, :KEPT_BYTES] = packed
    return out.view("<u8").ravel().astype(np.uint64)


def _keys(parts: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(parts.to_pylist()), dtype=np.int64)


def _marked(batch: pa.RecordBatch, marks) -> np.ndarray:
    """Of which rows the bit of ``row_key`` is set."""
    keys = batch.column("row_key").to_numpy(zero_copy_only=False).astype(np.int64)
    return in_map(marks.value, keys.view(np.uint64))


def _ranges(bits: int) -> int:
    """Bits of a map's address that name the range; ranges are slices of the map."""
    return min(RANGE_BITS, bits - 6)


def _counted(k: int, cut: np.uint64, first, bits: int) -> Callable:
    """Turns (row_key, text) rows into (range, tokens): tokens below the cut of first copies, at most ``OFTEN`` times each."""
    shift, mask = np.uint64(bits - _ranges(bits)), np.uint64((1 << _ranges(bits)) - 1)

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.sort(np.concatenate(held))
        keep = np.ones(len(tokens), dtype=bool)
        keep[OFTEN:] = tokens[OFTEN:] != tokens[:-OFTEN]
        tokens = tokens[keep]
        rows = list(_dealt(tokens, ((tokens >> shift) & mask).astype(np.int64)))
        return pa.RecordBatch.from_arrays(
            [pa.array([r for r, _ in rows], pa.int32()), pa.array([x for _, (x,) in rows], pa.binary())],
            names=["range", "tokens"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            batch = batch.filter(pa.array(_marked(batch, first)))
            for chunk in arrays.chunks(batch.column("text")):
                for x in shingle_sets(chunk, k):
                    held.append(x[: np.searchsorted(x, cut)].copy())
                    size += len(held[-1])
                if size >= HELD:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    return run


def _frequent(bits: int) -> Callable:
    """Turns the tokens of a range into its slices of the maps of frequent and of very frequent ones."""
    size = 1 << (bits - _ranges(bits))

    def run(table: pa.Table) -> pa.Table:
        tokens, counts = np.unique(_tokens(table["tokens"]), return_counts=True)
        at = (tokens & np.uint64(size - 1)).astype(np.int64)
        maps = []
        for least in (2, OFTEN):
            flags = np.zeros(size, dtype=bool)
            flags[at[counts >= least]] = True
            maps.append(np.packbits(flags, bitorder="little").tobytes())
        return pa.table(
            {"range": table["range"].slice(0, 1), "every": pa.array(maps[:1], pa.binary()), "also": pa.array(maps[1:], pa.binary())}
        )

    return run


def _frequency_maps(texts: DataFrame, k: int, rule: Threshold, first, bits: int) -> list[np.ndarray]:
    """Maps of frequent and of very frequent tokens; each range's slice is made by one task, and the slices reach the driver."""
    rows = (
        texts.where("doc_id IS NOT NULL")
        .select("row_key", "text")
        .mapInArrow(_counted(k, rule.cut, first, bits), "range int, tokens binary")
        .groupBy("range")
        .applyInArrow(_frequent(bits), "range int, every binary, also binary")
        .toArrow()
    )
    out = [np.zeros((1 << _ranges(bits), 1 << (bits - _ranges(bits) - 6)), dtype=np.uint64) for _ in range(2)]
    for r, *slices in zip(*(rows[c].to_pylist() for c in ("range", "every", "also")), strict=True):
        for words, x in zip(out, slices, strict=True):
            words[r] = np.frombuffer(x, dtype="<u8")
    return [x.ravel() for x in out]


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the numbers of tokens by their last bits: two to four bits a token, ``SKETCH_BITS`` at most."""
    bits = min(SKETCH_BITS, max(64, 1 << (2 * len(tokens) - 1).bit_length()))
    at = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def _signed(k: int, rule: Threshold, maps, first) -> Callable:
    """Turns (doc_id, text_key, row_key, text) rows into (doc_id, text_key, h, n, tokens, sketch); only first copies have signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken = _marked(batch, first) & batch.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
            for chunk in arrays.chunks(batch.column("text")):
                sets = list(shingle_sets(chunk, k))
                part = batch.slice(chunk.first, chunk.n)
                signs = [
                    signatures(x, *(in_map(m, x) for m in maps.value), rule) if own else x[:0]
                    for x, own in zip(sets, taken[chunk.first : chunk.first + chunk.n].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([set_key(x) for x in sets], pa.int64()),
                        pa.array([len(x) for x in sets], pa.int64()),
                        _lists(signs),
                        pa.array([sketch(x) if len(t) else None for x, t in zip(sets, signs, strict=True)], pa.binary()),
                    ],
                    names=["doc_id", "text_key", "h", "n", "tokens", "sketch"],
                )

    return run


def _whole(k: int, wanted) -> Callable:
    """Turns (row_key, text) rows into (h, tokens) of the wanted ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_marked(batch, wanted)))
            for chunk in arrays.chunks(batch.column("text")):
                sets = list(shingle_sets(chunk, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_key(x) for x in sets], pa.int64()), _lists(sets)], names=["h", "tokens"]
                )

    return run


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different pairs of different keys."""
    a, b = a[a != b], b[a != b]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _stars(tokens: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each token with the smallest of its owners, and the links (owner, smallest) of its other owners."""
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]])) if len(tokens) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(owners, starts) if len(tokens) else owners
    every = np.repeat(least, np.diff(np.append(starts, len(tokens))))
    return tokens[starts], least, *_distinct(owners, every)


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns (h, tokens) rows into (range, tokens, owners, a, b): stars within a task's rows as links, and one owner a token."""
    names = ["range", "tokens", "owners", "a", "b"]
    shift, last = np.uint64(8 * KEPT_BYTES - RANGE_BITS), np.uint64((1 << 8 * KEPT_BYTES) - 1)

    def packed(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        tokens, owners, a, b = _stars(*(np.concatenate(x) for x in zip(*held, strict=True)))
        rows: dict[int, list[bytes]] = {r: [*x, b"", b""] for r, x in _dealt(tokens, (tokens >> shift).astype(np.int64), owners)}
        for r, (_, x, y) in _dealt(a.view(np.uint64), a & ((1 << RANGE_BITS) - 1), a, b):
            rows.setdefault(r, [b"", b"", b"", b""])[2:] = [x, y]
        columns = [pa.array([x[i] for x in rows.values()], pa.binary()) for i in range(4)]
        return pa.RecordBatch.from_arrays([pa.array(list(rows), pa.int32()), *columns], names=names)

    held, size = [], 0
    for batch in batches:
        lists = batch.column("tokens")
        tokens = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) & last
        owners = batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64)
        held.append((tokens, owners[pc.list_parent_indices(lists).to_numpy()]))
        size += len(tokens)
        if size >= HELD:
            yield packed(held)
            held, size = [], 0
    if size:
        yield packed(held)


def _met(table: pa.Table) -> pa.Table:
    """Links (a, b) of the sets that meet in a range of signatures, as stars."""
    _, _, a, b = _stars(_tokens(table["tokens"]), _keys(table["owners"]))
    a, b = _distinct(np.concatenate([a, _keys(table["a"])]), np.concatenate([b, _keys(table["b"])]))
    return pa.table({"a": a, "b": b})


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a block's sets."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(x) for x in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    counts = np.diff(np.append(starts, len(tokens)))
    out = np.zeros((m, m), dtype=np.float32)
    flat = np.zeros(m * m, dtype=np.int64)
    for d in np.unique(counts[(counts > 1) & (counts < DENSE)]).tolist():
        members = owner[starts[counts == d][:, None] + np.arange(d)]
        i, j = np.triu_indices(d, 1)
        flat += np.bincount((members[:, i] * m + members[:, j]).ravel(), minlength=m * m)
    out += flat.reshape(m, m)
    out += out.T
    dense = np.flatnonzero(counts >= DENSE)
    for part in np.array_split(dense, max(1, -(-len(dense) // 2048))):
        columns = np.zeros((m, len(part)), dtype=np.float32)
        for c, (s, d) in enumerate(zip(starts[part].tolist(), counts[part].tolist(), strict=True)):
            columns[owner[s : s + d], c] = 1
        out += columns @ columns.T
    return out


def forest(links: np.ndarray) -> np.ndarray:
    """For a symmetric matrix of links, the smallest index reachable from each index."""
    root = np.arange(len(links))
    while True:
        near = np.where(links, root[None, :], len(root)).min(axis=1, initial=len(root))
        now = np.minimum(root, near)
        now = np.minimum(now, now[now])
        if (now == root).all():
            return root
        root = now


def _alike(num: int, den: int) -> Callable:
    """Turns sets of a unit (h, n, sketch) into a spanning forest of the pairs that may link by their sizes and sketches."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("h").to_numpy()
        sizes = table.column("n").to_numpy().astype(np.int64)
        sketches = table.column("sketch").to_pylist()
        widths = np.array([len(x) for x in sketches])
        links = np.zeros((len(keys), len(keys)), dtype=bool)
        for width in np.unique(widths).tolist():
            here, wide = np.flatnonzero(widths == width), np.flatnonzero(widths == 2 * width)
            bits = np.frombuffer(b"".join(sketches[i] for i in here), dtype=np.uint8).reshape(-1, width)
            # Parities by one bit less are those of the halves, added; sizes that link differ by less than a factor of two.
            halves = np.frombuffer(b"".join(sketches[i] for i in wide), dtype=np.uint8).reshape(-1, 2, width)
            both = np.concatenate([here, wide])
            signs = 1 - 2 * np.unpackbits(np.concatenate([bits, halves[:, 0] ^ halves[:, 1]]), axis=1).astype(np.float32)
            apart = (8 * width - signs[: len(here)] @ signs.T) / 2
            x, y = sizes[here][:, None], sizes[both][None, :]
            near = ((num + den) * apart <= (den - num) * (x + y)) & (den * np.minimum(x, y) >= num * np.maximum(x, y))
            links[np.ix_(here, both)] = near
            links[np.ix_(both, here)] = near.T
        np.fill_diagonal(links, False)
        root = forest(links)
        joined = root != np.arange(len(root))
        return pa.table({"a": keys[joined], "b": keys[root[joined]]})

    return run


def _verified(num: int, den: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        keys = table.column("h").to_numpy()
        sizes = table.column("n").to_numpy().astype(np.float64)
        lists = table.column("tokens").chunk(0)
        bounds = lists.offsets.to_numpy()
        values = lists.values.to_numpy()
        both = overlaps([values[a:b] for a, b in pairwise(bounds.tolist())])
        links = den * both.astype(np.float64) >= num * (sizes[:, None] + sizes[None, :] - both)
        np.fill_diagonal(links, False)
        root = forest(links)
        joined = root != np.arange(len(root))
        return pa.table({"a": keys[joined], "b": keys[root[joined]]})

    return run


def _blocks(members: DataFrame, rule: Threshold) -> DataFrame:
    """(unit, h): the pairs of blocks that can hold links, with their members.

    A group that fits is one block, paired with itself. Of a larger one a block holds sets
    of one band of sizes; sets of bands that are not neighbours differ too much to link.
    """
    blocks = F.expr(f"CAST(ceil(greatest(sum(n) / {BLOCK_SHINGLES}, count(*) / {BLOCK_SETS})) AS INT)")
    cuts = F.array(*(F.lit(x) for x in rule.lows))
    band = F.when(F.col("whole") == 1, 0).otherwise(F.size(F.filter(cuts, lambda x: x <= F.col("n"))))
    # Tables of a row per group are written, so that joins on a large group can be split.
    whole = stored(members.groupBy("root").agg(blocks.alias("whole")), "groups")
    banded = members.join(whole, "root").withColumn("band", band).drop("whole")
    sizes = stored(banded.groupBy("root", "band").agg(blocks.alias("blocks")), "sizes")
    bands = F.explode(F.array("band", F.col("band") - 1, F.col("band") + 1)).alias("band")
    near = sizes.select("root", bands, F.col("band").alias("other"), F.col("blocks").alias("others")).join(
        sizes.select("root", "band"), ["root", "band"]
    )
    # A unit of two neighbouring bands compares all its sets, also those of one band.
    alone = F.count("*").over(Window.partitionBy("root", "band")) == 1
    near = near.withColumn("alone", alone).where("band <> other OR others > 1 OR alone").drop("alone")
    own = banded.join(sizes, ["root", "band"]).withColumn("block", F.expr("CAST(pmod(xxhash64(h), blocks) AS INT)"))
    pairs = own.join(near, ["root", "band"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
    here, there = F.struct("band", "block"), F.struct(F.col("other").alias("band"), F.col("j").alias("block"))
    return pairs.select(
        F.xxhash64("root", F.least(here, there), F.greatest(here, there)).alias("unit"), "h", "n"
    )


def near_duplicates(
    docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, map_bits: int = MAP_BITS
) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id) for every row of ``docs``.

    Rows link when ``den * intersection >= num * union`` of their ``k``-word shingles;
    ``component_id`` is the smallest ``doc_id`` reachable by links.
    """
    joined = _grouped(docs, k, num, den, map_bits)
    smallest = stored(
        joined.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("smallest")), "smallest"
    )
    return joined.join(smallest, "root", "left").select(
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        F.coalesce("smallest", "doc_id").alias("component_id"),
    )


def _grouped(docs: DataFrame, k: int, num: int, den: int, map_bits: int = MAP_BITS) -> DataFrame:
    """(doc_id, text_key, n, root) for every row of ``docs``; rows that links reach share ``root``, null where there is no set."""
    spark, rule = docs.sparkSession, Threshold(num, den)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    row_key = F.xxhash64("doc_id", "text_key").alias("row_key")
    texts = docs.select("doc_id", text_key().alias("text_key"), "text").select("doc_id", "text_key", row_key, "text")

    # One row of each text is counted and signed; a chance bit adds work for a copy.
    copies = texts.where("doc_id IS NOT NULL").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    first = spark.sparkContext.broadcast(bit_map(copies.select(row_key.alias("h")), map_bits))
    maps = spark.sparkContext.broadcast(_frequency_maps(texts, k, rule, first, map_bits))
    rows = stored(
        texts.mapInArrow(
            _signed(k, rule, maps, first),
            f"doc_id {id_type}, text_key bigint, h bigint, n bigint, tokens array<bigint>, sketch binary",
        ),
        "signatures",
    )
    signed = rows.where("size(tokens) > 0")
    meeting = (
        signed.select("h", "tokens")
        .mapInArrow(_meetings, "range int, tokens binary, owners binary, a binary, b binary")
        .groupBy("range")
        .applyInArrow(_met, "a bigint, b bigint")
    )
    met = stored(
        signed.select("h", "n", "sketch")
        .dropDuplicates(["h"])
        .join(components(meeting), F.col("h") == F.col("node"))
        .select("h", "n", "sketch", "root"),
        "met",
    )
    alike = (
        met.select("h", "n", "sketch")
        .join(_blocks(met.drop("sketch"), rule).select("unit", "h"), "h")
        .groupBy("unit")
        .applyInArrow(_alike(num, den), "a bigint, b bigint")
    )
    members = stored(
        met.select("h", "n").join(components(alike), F.col("h") == F.col("node")).select("h", "n", "root"), "members"
    )

    # Whole sets of the members only: one row of each is found again by a map of the rows.
    reps = signed.groupBy("h").agg(F.min(F.struct("text_key", "doc_id")).alias("rep"))
    reps = reps.join(members.select("h"), "h").select("rep.*").select(row_key.alias("h"))
    wanted = spark.sparkContext.broadcast(bit_map(reps, map_bits))
    sets = (
        texts.select("row_key", "text")
        .mapInArrow(_whole(k, wanted), "h bigint, tokens array<bigint>")
        .dropDuplicates(["h"])
    )
    links = (
        sets.join(_blocks(members, rule), "h")
        .groupBy("unit")
        .applyInArrow(_verified(num, den), "a bigint, b bigint")
    )
    linked = components(links)
    return stored(
        rows.join(linked, F.col("h") == F.col("node"), "left").select(
            "doc_id",
            "text_key",
            "n",
            F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.coalesce("root", "h")).alias("root"),
        ),
        "joined",
    )


def deduplicate(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One document of each group of near duplicates: of the smallest ``doc_id``. All columns.

    Rows without ``doc_id`` and documents without shingles stay. Should rows of a group share the
    smallest ``doc_id``, the text with the smallest key stays; rows that repeat both stay with it.
    """
    joined = _grouped(docs, k, num, den)
    row = F.struct("doc_id", "text_key")
    first = stored(joined.where("root IS NOT NULL").groupBy("root").agg(F.min(row).alias("first")), "first")
    dropped = (
        joined.join(first, "root")
        .where(row != F.col("first"))
        .select(F.col("doc_id").alias("d_id"), F.col("text_key").alias("d_key"))
        .distinct()
    )
    return docs.join(
        dropped, (docs["doc_id"] == dropped["d_id"]) & (text_key(docs["text"]) == dropped["d_key"]), "left_anti"
    )
