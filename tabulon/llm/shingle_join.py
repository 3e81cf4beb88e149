"""Exact Jaccard join on word shingles and the groups that its links form.

Documents with the same shingle set are one class. A class of few shingles enumerates the pairs of
tokens of its prefix, a large one the single tokens; classes that meet under such a key are candidates.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.components import components
from tabulon.llm.tables import if_small, store, text_key
from tabulon.llm.words import LOWER, Runs, find_words, list_column, mix, signed, slices, text_bytes
from tabulon.session import Scratch, scratch_tables

SHINGLE = 5
PERCENT = 80
COUNTED_AT_ONCE = 4_000_000  # shingles
FREQUENT_BYTES = 8_000_000
LARGEST_BOUNDARY = 64
MOST_KEYS = 3  # written for a token of a small set, whatever the list that they spare
FEW = 8  # classes under a key up to which all pairs are formed
CROWD = 256  # classes under a key beyond which whole sets are sketched and blocks formed
PARTS = 2  # of the keys, which are shuffled one part after the other
SLICE_BYTES = 1_000_000  # of texts whose shingles are formed at once
COLUMNS_AT_ONCE = 8_192  # of a comparison of the sketches of a block
PAIRS_AT_ONCE = 65_536


def _shingle_sets(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each text, smallest first, as values and offsets; word counts.

    A text of fewer words than a shingle has one, all its words; a text without words has none.
    """
    words = find_words(*text_bytes(batch.column("text")), LOWER)
    counts = words.counts
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    start = words.first[:-1][row] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    end = np.minimum(start + width, words.first[1:][row])
    value = Runs(words.hashes)(start, end)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    fresh = np.ones(len(row), dtype=bool)
    fresh[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    row, value = row[fresh], value[fresh]
    return value, np.searchsorted(row, np.arange(len(counts) + 1)), counts


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _frequent(docs: DataFrame, width: int, scratch: Scratch) -> np.ndarray:
    """Shingles that several documents read by one task have, the most frequent ones, sorted. They only
    order the tokens: which ones are found changes the work and not the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending, size = [np.empty(0, np.uint64)], 0
        for batch in slices(batches, "text", SLICE_BYTES):
            pending.append(_shingle_sets(batch, width)[0])
            size += len(pending[-1])
            if size > COUNTED_AT_ONCE:
                yield _repeated(pending)
                pending, size = [np.empty(0, np.uint64)], 0
        yield _repeated(pending)

    counts = docs.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    counts = store(counts)
    most = FREQUENT_BYTES // 8
    least, kept = 2, 0
    for n, shingles in counts.groupBy("n").agg(F.count("*")).orderBy(F.desc("n")).toLocalIterator():
        kept += shingles
        if kept > most:
            least = n + 1
            break
    rows = counts.where(F.col("n") >= least).select("shingle").toPandas()["shingle"]  # at most ``most``
    scratch.drop(counts)
    return np.sort(rows.to_numpy(np.int64).view(np.uint64))


def _repeated(shingles: list[np.ndarray]) -> pa.RecordBatch:
    values = np.concatenate(shingles)
    shingles.clear()
    values.sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(fresh)
    n = np.diff(first, append=len(values))
    some = n > 1
    return pa.RecordBatch.from_arrays([pa.array(signed(values[first[some]])), pa.array(n[some])], names=["shingle", "n"])


def _profiles(docs: DataFrame, frequent: np.ndarray, width: int, percent: int) -> DataFrame:
    """Per document: number of shingles, 128 bits that name the set, and the tokens of its prefix with
    one more, rarest first, so that the prefix of single tokens is all of them but the last; ``late`` and ``last``
    tell where in the common order of tokens that prefix ends."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    schema = "id long, doc_id long, t1 long, t2 long, n long, s1 long, s2 long, tokens array<long>, late boolean, last long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = shared.value
        for batch in slices(batches, "text", SLICE_BYTES):
            value, offsets, _ = _shingle_sets(batch, width)
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n)), n)
            late = np.zeros(len(value), dtype=bool)
            if len(often):
                at = np.minimum(np.searchsorted(often, value), len(often) - 1)
                late = often[at] == value
            order = np.lexsort((value, late, row))  # rows stay together, their frequent shingles go last
            length = np.minimum(n, n - (percent * n + 99) // 100 + 2)
            place = np.arange(len(value)) - offsets[:-1][row]
            tokens = value[order][place < length[row]]
            some = np.flatnonzero(n > 0)
            ends = (offsets[:-1] + length - np.where(n > 1, 2, 1))[some]
            ends_late, ends_at = np.zeros(len(n), dtype=bool), np.zeros(len(n), dtype=np.uint64)
            ends_late[some], ends_at[some] = late[order][ends], value[order][ends]
            first, second = _sums(mix(value), offsets), _sums(mix(value ^ np.uint64(0x5851F42D4C957F2D)), offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"), batch.column("doc_id"), batch.column("_t1"), batch.column("_t2"), pa.array(n), pa.array(signed(mix(first))),
                    pa.array(signed(mix(second))), list_column(pa.array(signed(tokens)), np.where(n > 0, length, 0)),
                    pa.array(ends_late), pa.array(signed(ends_at ^ np.uint64(1 << 63))),
                ],
                names=["id", "doc_id", "t1", "t2", "n", "s1", "s2", "tokens", "late", "last"],
            )

    return docs.select("id", F.col("doc_id").cast("long").alias("doc_id"), "text", *text_key()).mapInArrow(run, schema)


def light_keys(tokens: Column, n: Column) -> Column:
    """(key, most) for each pair of tokens; see ``_keys``."""

    def key(x: Column, y: Column, at: Column) -> Column:
        return F.struct(F.xxhash64(F.least(x, y), F.greatest(x, y)).alias("key"), (n - at + 1).cast("int").alias("most"))

    pairs = F.transform(
        tokens, lambda x, i: F.transform(F.slice(tokens, i + 2, F.size(tokens)), lambda y, j: key(x, y, i + j + 1))
    )
    return F.flatten(pairs)


def boundary(classes: DataFrame) -> int:
    """Number of shingles up to which pairs of tokens are enumerated.

    For each size the pairs are weighed against reading the lists of the single tokens, whose mean
    length, as a token meets it, is measured on the stored prefixes; the size where the lists become the
    cheaper way ends the light part. A list is met row by row or in blocks, so that it spares a token no more
    than ``MOST_KEYS`` keys.
    """
    lists = classes.where(F.col("n") <= LARGEST_BOUNDARY).select("n", F.explode("tokens").alias("token"))
    per_token = lists.groupBy("token").agg(F.count("*").alias("list"))
    mean = per_token.agg(F.sum(F.col("list") * F.col("list")) / F.sum("list")).first()[0] or 1.0
    best = 1
    for n in range(2, LARGEST_BOUNDARY + 1):
        prefix = n - (PERCENT * n + 99) // 100 + 1
        pairs = (prefix + 1) * prefix / 2
        if pairs <= prefix * min(mean, MOST_KEYS):
            best = n
    return best


_SINGLE = "if(n >= 2, slice(tokens, 1, size(tokens) - 1), tokens)"


def _keys(classes: DataFrame, border: int) -> DataFrame:
    """(key, c, n, most): light sizes under pairs, heavy ones under tokens, and those just above the border,
    which may link to either, under both. Pairs and tokens never share a key but by chance.

    ``most`` is how many tokens a class can share with another if this token, or the second of this pair, is the first (second) in
    the common order that both have. Two classes that link meet under the key of their first common tokens, where the smaller of
    their two bounds is enough for a link; so under any other key it may be asked, too.
    """
    n = F.col("n")
    light = classes.where((n * PERCENT <= border * 100) & (n >= 2))
    heavy = classes.where(n > border)
    tokens = F.posexplode(F.expr(_SINGLE)).alias("at", "key")
    return heavy.select(tokens, "c", "n").select("key", "c", "n", (n - F.col("at")).cast("int").alias("most")).unionByName(
        light.select(F.explode(light_keys(F.col("tokens"), n)).alias("k"), "c", "n").select("k.key", "c", "n", "k.most")
    )


def _met(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``keys`` whose key several classes have; most are met by one alone, and those are counted and go no
    further. Nothing but the key is shuffled to be counted, and the shuffle files of one part are gone before the next begins."""
    met = []
    for part in range(PARTS):
        own = keys.where(F.pmod("key", F.lit(PARTS)) == part)
        shared = store(own.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key"))
        met.append(store(own.join(shared, "key")))
        scratch.drop(shared)
    rows = store(reduce(DataFrame.unionByName, met))
    scratch.drop(*met)
    return rows


def _enough(most: Column, a: str, b: str) -> Column:
    """Whether sets of ``a`` and ``b`` shingles link if they share ``most``."""
    return most * (100 + PERCENT) >= (F.col(a) + F.col(b)) * PERCENT


def _sizes_fit(a: str, b: str) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that the prefixes do not rule out.

    Of the class whose prefix ends first, every token of the prefix that the other has lies in the other's
    prefix. So no more is common than the shared tokens of the prefixes and the rest of that class. Tokens are compared
    by 16 bits, which can only count too many, if those that coincide within a class are added.
    """
    sketch = _sketch(F.expr(_SINGLE))
    short = classes.select("c", "n", "late", "last", sketch.alias("k"))

    def side(name: str) -> DataFrame:
        return short.select(F.col("c").alias(name), F.struct("n", "k", F.struct("late", "last").alias("end")).alias(f"_{name}"))

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    x = F.when(F.col("_a.end") <= F.col("_b.end"), F.col("_a")).otherwise(F.col("_b"))
    shared = F.size(F.array_intersect("_a.k", "_b.k")) + F.size(x["k"]) - F.size(F.array_distinct(x["k"]))
    most = shared + x["n"] - F.size(x["k"])
    return both.where(100 * most >= PERCENT * (F.col("_a.n") + F.col("_b.n") - most)).select("a", "b")


def _linked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity, judged on the whole sets."""
    pairs = store(_possible(pairs, classes))
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).distinct()
    wanted = store(wanted.join(classes, "c").select("c", "t.t1", "t.t2"))
    sets = _sets_of(docs, wanted, width)
    left = sets.select(F.col("c").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("c").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    judged = pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb", common.alias("common"))
    whole = F.size("sa") + F.size("sb") - F.col("common")
    links = store(judged.where(100 * F.col("common") >= PERCENT * whole).select("a", "b"))
    scratch.drop(pairs, wanted, sets)
    return links


def _sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(c, shingles) of the classes ``wanted`` (c, t1, t2), read from one of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            value, offsets, _ = _shingle_sets(batch, width)
            sets = list_column(pa.array(signed(value)), np.diff(offsets))
            yield pa.RecordBatch.from_arrays([batch.column("c"), sets], names=["c", "shingles"])

    keyed = docs.select("text", *text_key())
    found = keyed.join(if_small(wanted, 40), (F.col("_t1") == F.col("t1")) & (F.col("_t2") == F.col("t2")))
    return store(found.select("c", "text").dropDuplicates(["c"]).mapInArrow(run, "c long, shingles array<long>"))


def _apart(
    tagged: DataFrame, docs: DataFrame, classes: DataFrame, width: int, crowd: int, scratch: Scratch, best_only: bool
) -> DataFrame:
    """(a, b): classes that share a key, are in different groups and may link.

    A few classes under a key are paired as they are. More meet in one task, a crowd in blocks of bounded size, and
    only the pairs that their sketches do not rule out leave it: 16 bits of each token of the prefix or, in a crowd, of the whole set. A pair of a
    crowd leaves it under its first common token alone. With ``best_only`` each class leaves a block of more than a few with the one class before it that it
    may share most with, which joins most of a crowd of near copies by a linear number of pairs before all that are left are formed.
    """
    keys = tagged.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("size"))
    keys = store(keys.where("lo != hi").select("key", "size"))
    stored = store(tagged.join(keys, "key"))
    few, still = stored.where(F.col("size") <= FEW), stored.where(F.col("size") > FEW)

    def side(name: str) -> DataFrame:
        return few.select("key", F.col("c").alias(name), F.struct("n", "g", "most").alias(f"_{name}"))

    paired = side("a").join(side("b"), "key").where("a < b and _a.g != _b.g")
    paired = paired.where(_enough(F.least("_a.most", "_b.most"), "_a.n", "_b.n"))
    crowded = store(still.where(F.col("size") > crowd).select("c").distinct().join(classes, "c").select("c", "t.t1", "t.t2"))
    sets = _sets_of(docs, crowded, width)
    whole = sets.select("c", _sketch(F.col("shingles")).alias("k"))
    prefix = F.expr(_SINGLE)
    ends = ["late", "last", F.size(prefix).alias("p")]
    small = still.where(F.col("size") <= crowd).join(
        classes.select("c", *ends, _sketch(prefix).alias("k"), F.array().cast("array<long>").alias("tokens")), "c"
    )
    large = still.where(F.col("size") > crowd).join(
        classes.join(if_small(crowded.select("c"), 16), "c", "left_semi").select("c", *ends, prefix.alias("tokens")).join(whole, "c"), "c"
    )
    columns = ["key", "c", "n", "most", "g", "size", "late", "last", "p", "k", "tokens"]
    blocks = F.ceil(F.col("size") / float(2 * crowd)).cast("int")
    own = F.when(blocks > 1, F.pmod(F.xxhash64("c"), blocks)).otherwise(0).cast("int")
    rows = small.select(columns).unionByName(large.select(columns)).select(
        *columns, own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    )
    rows = rows.withColumn("block", F.concat_ws(",", F.least("own", "other"), F.greatest("own", "other")))
    dealt = rows.repartition("key", "block").sortWithinPartitions("key", "block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            border = _borders(rest)[-2]
            yield from _survivors(rest.slice(0, border), crowd, best_only)
            rest = rest.slice(border)
        if rest is not None:
            yield from _survivors(rest, crowd, best_only)

    dealt = dealt.mapInArrow(compare, "a long, b long")
    pairs = store((dealt if best_only else paired.select("a", "b").unionByName(dealt)).distinct())
    scratch.drop(keys, stored, crowded, sets)
    return pairs


def _sketch(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.shiftright(x, 48).cast("short"))


def _borders(table: pa.Table) -> np.ndarray:
    """Where the rows of a new (key, block) begin, and the end."""
    key = table.column("key").to_numpy()
    block = table.column("block").combine_chunks().dictionary_encode()
    code = (block.combine_chunks() if isinstance(block, pa.ChunkedArray) else block).indices.to_numpy()
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1])
    return np.append(np.flatnonzero(fresh), len(key))


def _lists(table: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = table.column(name).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(), offsets - offsets[0]


def _survivors(table: pa.Table, crowd: int, best_only: bool) -> Iterator[pa.RecordBatch]:
    if not table.num_rows:
        return
    borders = _borders(table)
    c, n, g, size, late, last, p, own, other, key, bound = (
        table.column(x).to_numpy() for x in ("c", "n", "g", "size", "late", "last", "p", "own", "other", "key", "most")
    )
    sketch, at = _lists(table, "k")
    tokens, token_at = _lists(table, "tokens")
    left, right, waiting = [], [], 0
    for s, e in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if e - s < 2:
            continue
        values, columns = np.unique(sketch[at[s] : at[e]], return_inverse=True)
        counts = np.diff(at[s : e + 1])
        cells = np.unique(np.repeat(np.arange(e - s), counts) * len(values) + columns)
        row, column = cells // len(values), cells % len(values)
        same = counts - np.bincount(row, minlength=e - s)  # tokens that fall together
        shared = np.bincount(column) > 1
        place = np.cumsum(shared) - 1
        row, column = row[shared[column]], place[column[shared[column]]]
        common = np.zeros((e - s, e - s), dtype=np.float32)
        for first in range(0, int(shared.sum()), COLUMNS_AT_ONCE):
            here = (column >= first) & (column < first + COLUMNS_AT_ONCE)
            has = np.zeros((e - s, min(COLUMNS_AT_ONCE, int(shared.sum()) - first)), dtype=np.float32)
            has[row[here], column[here] - first] = 1
            common += has @ has.T
        common = np.rint(common).astype(np.int64)
        size_of, group = n[s:e], g[s:e]
        if size[s] > crowd:
            most = common + np.minimum(same[:, None], same[None, :])
        else:
            rank = np.empty(e - s, dtype=np.int64)
            rank[np.lexsort((last[s:e], late[s:e]))] = np.arange(e - s)
            rest = same + size_of - p[s:e]
            most = common + np.where(rank[:, None] < rank[None, :], rest[:, None], rest[None, :])
        most = np.minimum(most, np.minimum(bound[s:e][:, None], bound[s:e][None, :]))
        good = 100 * most >= PERCENT * (size_of[:, None] + size_of[None, :] - most)
        good &= group[:, None] != group[None, :]
        if own[s:e].min() != own[s:e].max() or (own[s:e] != other[s:e]).any():  # two blocks: one from either
            good &= own[s:e][:, None] != own[s:e][None, :]
        good = np.triu(good, 1)
        if best_only:
            rated = np.where(good, most, -1)
            after = np.flatnonzero(good.any(axis=0))
            ends = rated[:, after].argmax(axis=0), after
        else:
            ends = np.nonzero(good)
        one, two = s + ends[0], s + ends[1]
        if size[s] > crowd and not best_only:
            stays = np.ones(len(one), dtype=bool)
            for at_pair, (a, b) in enumerate(zip(one.tolist(), two.tolist(), strict=True)):
                own_tokens = tokens[token_at[a] : token_at[a + 1]]
                both = own_tokens[np.isin(own_tokens, tokens[token_at[b] : token_at[b + 1]])]
                stays[at_pair] = not (len(both) and both[0] != key[s] and key[s] in both)
            one, two = one[stays], two[stays]
        left.append(np.minimum(c[one], c[two]))
        right.append(np.maximum(c[one], c[two]))
        waiting += len(one)
        if waiting > PAIRS_AT_ONCE:
            yield _pairs(left, right)
            left, right, waiting = [], [], 0
    if waiting:
        yield _pairs(left, right)


def _pairs(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (left, right)], names=["a", "b"])


def similar_groups(
    docs: DataFrame, width: int = SHINGLE, crowd: int = CROWD, row_id: str | None = None
) -> DataFrame:
    """(doc_id, n_shingles, component_id, group, id) of each document of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased. Two documents link if their sets of ``width``-word
    shingles have a Jaccard similarity of 0.8 or more; ``component_id`` is the least doc_id that links
    lead to. A text of fewer words has one shingle; null texts and those without words have none and link
    with nothing. Repeated rows are in one group. A null doc_id takes part in the links; if it is alone with its
    kind the component is null. ``group`` names a group by a number, null for a text without words; ``id`` is the column ``row_id``, if given.

    Every linked pair of classes meets under some key. Keys of one class alone are counted and left. Classes that share many keys with the
    first class under them are judged against it, which joins groups of near copies in a linear number of pairs; then the pairs under a key that are
    still in different groups and that their places under it and their sketches allow are judged. Frequent shingles are ordered last, so prefixes rarely hold them.
    """
    docs = docs.select((F.col(row_id) if row_id else F.lit(None)).cast("long").alias("id"), "doc_id", "text")
    with scratch_tables(docs.sparkSession) as scratch:
        profiles = store(_profiles(docs, _frequent(docs, width, scratch), width, PERCENT))
        grouped = (
            profiles.where("n > 0")
            .groupBy("n", "s1", "s2")
            .agg(F.min("doc_id").alias("least"), F.min(F.struct("t1", "t2")).alias("t"), F.first("tokens").alias("tokens"), F.first("late").alias("late"), F.first("last").alias("last"))
        )
        classes = store(grouped.withColumn("c", F.monotonically_increasing_id()))
        members = store(profiles.select("id", "doc_id", "n", "s1", "s2"))
        scratch.drop(profiles)
        met = _met(_keys(classes, boundary(classes)), scratch)
        links = _linked(_with_first(met), docs, classes, width, scratch)
        # from here on groups, not classes, are joined: of the links between two groups one is left
        group_of = store(_regrouped(classes.select("c", F.col("c").alias("g")), components(links)))
        tagged = store(met.join(group_of, "c").select("key", "c", "n", "most", "g"))
        scratch.drop(met)
        for best_only in (True, False):
            across = _apart(tagged, docs, classes, width, crowd, scratch, best_only)
            if best_only and across.isEmpty():
                continue
            more = _linked(across, docs, classes, width, scratch)
            for end in ("a", "b"):
                more = more.join(group_of.select(F.col("c").alias(end), F.col("g").alias(f"g{end}")), end)
            merged = components(more.select("ga", "gb").distinct(), "ga", "gb")
            group_of = store(_regrouped(group_of, merged))
            if best_only:
                before, tagged = tagged, store(_regrouped(tagged, merged))
                scratch.drop(before)
        scratch.drop(tagged)
        names = classes.select("c", "least", "n", "s1", "s2").join(group_of, "c")
        named = store(names.select("n", "s1", "s2", "g", "least"))
        smallest = named.groupBy("g").agg(F.min("least").alias("component_id"))
        out = store(named.drop("least").join(smallest, "g"))
        scratch.keep(members, out)
    return members.join(out, ["n", "s1", "s2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.col("g").alias("group"),
        "id",
    )


def _regrouped(rows: DataFrame, merged: DataFrame) -> DataFrame:
    """``rows`` with the groups ``g`` renamed to the components that they have become part of."""
    joined = rows.join(merged, F.col("g") == merged.node, "left").withColumn("g", F.coalesce("component", "g"))
    return joined.select(rows.columns)


def _with_first(met: DataFrame) -> DataFrame:
    """(a, b): classes with the first class under their keys, where the two meet under half the keys or more that linked
    classes would share at least, or where their places under one would allow a link. Groups of near copies so form in a
    linear number of pairs; what is left out here is judged later."""
    a, b = F.col("p.n"), F.col("n")
    shared = (a + b) * PERCENT / (100.0 + PERCENT) - F.least(a, b) * PERCENT / 100.0  # of the prefix of the smaller set
    first = met.groupBy("key").agg(F.min(F.struct("c", "n", "most")).alias("p"))
    pairs = met.join(first, "key").where(F.col("c") != F.col("p.c")).where(_sizes_fit("n", "p.n"))
    early = _enough(F.least("most", "p.most"), "n", "p.n")
    often = pairs.groupBy(F.col("p.c").alias("a"), F.col("c").alias("b"))
    often = often.agg(F.count("*").alias("m"), F.min(shared).alias("shared"), F.max(early).alias("early"))
    return often.where("early or 2 * m >= shared").select("a", "b")
