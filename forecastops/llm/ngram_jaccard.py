"""Self-join of documents by the Jaccard similarity of their word n-grams, as a T-occurrence search with DivideSkip.

Two documents of nx and ny distinct n-grams reach the similarity if they share at least T(nx, ny) of them, that is if one
occurs in T of the other's inverted lists. DivideSkip merges only the short lists and probes the long ones: a document's
n-grams are ordered from rare to frequent, the lists of its last ceil(t * n) - 1 n-grams are long for it, and the rest, its
head, are merged. A pair must then meet in max(1, T - the larger number of long lists) merged lists; pairs that do are
candidates, and the long lists are probed for them by binary search in the sorted n-grams.

Candidates in one component of verified links need no check, as only components are wanted. So rounds of checks against
the most central document of each list come first; they join groups of near copies without pairing them up. The last round
then merges the lists between components, exactly. There, a pair is made where its first common list, in an order from short
to long ones, may be, not in every common list; then the parity bits of the sets must allow the overlap (bits that differ never
outnumber the n-grams in which two sets differ), and the common lists of the pair are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecastops.llm.components import components
from forecastops.session import cut, python_batches, small_side, store

#: Words of an n-gram, and similarity in per cent from which documents are linked.
WORDS, PERCENT = 5, 75
#: Bins of the frequency table that orders the n-grams. Any order gives the same links; a good one keeps lists short.
ORDER_BINS = 1 << 20
#: Rounds of checks against central documents before the exact round.
HUB_ROUNDS = 2
#: 64-bit numbers that hold the parity bits of a set.
PARITY = 8
#: Lists before a common one that are looked at for an earlier common one. Any number gives the same pairs.
BEFORE = 4
_PIECES = 64
_ADDED = 512
_P = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def shingle_sets(texts: pd.Series, k: int = WORDS) -> Iterator[tuple[np.ndarray, bytes]]:
    """Of each text: sorted distinct 64-bit hashes of its ``k``-word shingles, and a 16-byte digest of its word sequence.

    A-Z are lower-cased; words end at blanks, tabs and line ends. A text of fewer words is one shingle; one without words has
    none, and an empty digest.
    """
    column = pc.ascii_trim_whitespace(pc.ascii_lower(pa.array(texts, type=pa.large_string(), from_pandas=True).fill_null("")))
    lists = pc.ascii_split_whitespace(column)
    bounds = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    flat = hashes[coded.indices.to_numpy()] if len(coded) else np.empty(0, dtype=np.uint64)
    some = pc.not_equal(column, "").to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        if len(flat) >= k:
            rolled = flat[: len(flat) - k + 1]
            for i in range(1, k):
                rolled = rolled * _P + flat[i : len(flat) - k + 1 + i]
            rolled = _mixed(rolled)
        for i, has in enumerate(some):
            if not has:
                yield np.empty(0, dtype=np.uint64), b""
                continue
            words = flat[bounds[i] : bounds[i + 1]]
            digest = xxhash.xxh3_128_digest(words.tobytes())
            if len(words) >= k:
                yield np.unique(rolled[bounds[i] : bounds[i + 1] - k + 1]), digest
            else:
                yield np.array([xxhash.xxh64_intdigest(words.tobytes(), seed=1)], dtype=np.uint64), digest


def required(nx, ny, percent: int = PERCENT):
    """Least overlap of sets of nx and ny elements with a Jaccard similarity of ``percent`` per cent."""
    return -((-percent * (nx + ny)) // (100 + percent))


def parity_bits(grams: np.ndarray) -> np.ndarray:
    """Of each of ``PARITY`` * 64 places, whether an odd number of the n-grams fall there, as 64-bit numbers."""
    counts = np.bincount(((grams >> np.uint64(20)) % np.uint64(PARITY * 64)).astype(np.int64), minlength=PARITY * 64)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _long_lists(n, percent: int):
    """Lists of a set of ``n`` elements that are long for it: one less than the least overlap with any partner."""
    return -((-percent * n) // 100) - 1


def frequency_table(docs: DataFrame, bins: int = ORDER_BINS, k: int = WORDS) -> np.ndarray:
    """Documents with an n-gram of each bin. Tables of tasks are cut into pieces and added up in two steps; one table of
    ``bins`` numbers comes to the driver, whatever the corpus. ``docs`` has text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(bins, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 2000):
                sets = [s for s, _ in shingle_sets(batch["text"].iloc[at : at + 2000], k)]
                table += np.bincount((np.concatenate(sets) & np.uint64(bins - 1)).astype(np.int64), minlength=bins)
        task = TaskContext.get().partitionId() // _ADDED
        for piece, part in enumerate(np.split(table, _PIECES)):
            yield pd.DataFrame({"piece": [piece], "task": [task], "counts": [part.astype("<i8").tobytes()]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, dtype="<i8") for c in group["counts"])
        return pd.DataFrame({"piece": group["piece"].iloc[:1], "task": [0], "counts": [total.tobytes()]})

    schema = "piece int, task int, counts binary"
    tables = docs.select("text").mapInPandas(count, schema)
    added = tables.groupBy("piece", "task").applyInPandas(add, schema).groupBy("piece").applyInPandas(add, schema)
    pieces = {r.piece: np.frombuffer(r.counts, dtype="<i8") for r in added.collect()}
    return np.concatenate([pieces[i] for i in sorted(pieces)]) if pieces else np.zeros(bins, dtype=np.int64)


def described(docs: DataFrame, table: np.ndarray, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, digest of the word sequence, n (size of the set), parity (bits of the set) and head: the rarest n-grams in
    order, as 32-bit numbers.

    Two n-grams with one number only make candidates more. ``docs`` has id and text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table.astype(np.int64))

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = shared.value
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                digests, sizes, parities, heads = [], [], [], []
                for grams, digest in shingle_sets(part["text"], k):
                    merged = len(grams) - _long_lists(len(grams), percent) if len(grams) else 0
                    order = np.lexsort((grams, frequent[(grams & np.uint64(len(frequent) - 1)).astype(np.int64)]))
                    heads.append((grams[order[:merged]] >> np.uint64(32)).astype(np.uint32).view(np.int32))
                    digests.append(digest)
                    parities.append(parity_bits(grams))
                    sizes.append(len(grams))
                yield pd.DataFrame({"id": part["id"], "digest": digests, "n": sizes, "parity": parities, "head": heads})

    return docs.mapInPandas(describe, f"id {docs.schema['id'].dataType.simpleString()}, digest binary, n long, parity array<long>, head array<int>")


def verified(pairs: DataFrame, docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) that reach the similarity: b's n-grams are probed by binary search for a's. ``docs`` has id, text."""
    wanted = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    texts = store(docs.join(small_side(wanted), "id", "left_semi"))

    @F.pandas_udf("boolean")
    def linked(left: pd.Series, right: pd.Series) -> pd.Series:
        out = np.zeros(len(left), dtype=bool)
        for at in range(0, len(left), 500):
            a = shingle_sets(left.iloc[at : at + 500], k)
            b = shingle_sets(right.iloc[at : at + 500], k)
            for i, ((x, _), (y, _)) in enumerate(zip(a, b)):
                if len(x) and len(y):
                    place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    out[at + i] = (y[place] == x).sum() >= required(len(x), len(y), percent)
        return pd.Series(out)

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").filter(linked("text_a", "text_b")).select("a", "b").distinct()


def _fits(na: Column, nb: Column, percent: int) -> Column:
    return 100 * F.least(na, nb) >= percent * F.greatest(na, nb)


def _relabelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """``lists`` with each document's component brought up to date; ``labels`` maps old components to new ones."""
    moved = lists.join(labels.withColumnRenamed("node", "comp"), "comp", "left")
    return moved.withColumn("comp", F.coalesce("component", "comp")).drop("component")


def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: id, n_shingles (size of its set) and component_id (smallest id reachable by links, its own included).

    Documents link when the Jaccard similarity of their sets is ``percent`` per cent or more. Documents without words link
    with nothing; rows that repeat an id are one document and share its component; a null id has a null component and no
    links; an empty table gives no rows. Equal word sequences are one node from the start. Ids are integers.
    """
    # all Python work is done when this returns; what is left to compute are joins
    with python_batches(docs.sparkSession):
        return _groups(docs, id_col, text_col, k, percent)


def _groups(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = store(described(texts, frequency_table(texts, k=k), k, percent))
    named = known.filter("id is not null and n > 0")
    # equal word sequences: the smallest id stands for all
    classes = store(named.groupBy("digest").agg(F.min("id").alias("rep"), F.count("*").alias("size")))
    reps = classes.select(F.col("rep").alias("id")).distinct()
    heads = named.join(reps, "id", "left_semi").dropDuplicates(["id", "digest"])
    # inverted lists of two documents or more; counts and lists read the same shuffle
    postings = heads.select("id", "n", F.size("head").alias("merged"), F.explode("head").alias("gram")).repartition("gram")
    lists = postings.join(postings.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1"), "gram")
    lists = store(lists.select("gram", "id", "n", "merged", F.col("id").alias("comp")))
    # a document of whose head most is shared is central to its near copies
    central = lists.groupBy("id").agg((F.count("*") / F.first("merged")).alias("shared"))
    lists = store(lists.join(central, "id"))
    labels, checked = None, None
    for last in [False] * HUB_ROUNDS + [True]:
        pairs = _between_components(lists, _parities(heads), percent) if last else _hub_pairs(lists, percent)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = store(pairs)
        links = store(verified(pairs, texts, k, percent))
        comps = lists.select("id", "comp").distinct()
        ends = links.join(comps.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a").join(comps.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b")
        new = store(components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))))
        labels = new if labels is None else store(_followed(labels, new))
        if not last:
            checked = pairs if checked is None else checked.unionByName(pairs)
            lists = store(_relabelled(lists, new))
    # classes of one id belong together as well, so classes go by their smallest id
    placed = known.join(classes.select("digest", "rep"), "digest", "left")
    placed = placed.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    own = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.coalesce("component", "rep")).otherwise(F.col("id"))
    return placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"))


def _followed(labels: DataFrame, new: DataFrame) -> DataFrame:
    """Labels after the components of ``new`` have been joined."""
    moved = labels.join(new.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    fresh = new.join(labels.select("node"), "node", "left_anti")
    return moved.select("node", F.coalesce("to", "component").alias("component")).unionByName(fresh.select("node", "component"))


def _hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): each document with the central document of another component that it meets in most lists, one pair each."""
    order = F.struct("shared", -F.col("id"))
    hubs = lists.groupBy("gram").agg(F.max_by(F.struct("id", "n", "comp"), order).alias("hub"))
    met = lists.join(hubs, "gram").filter((F.col("comp") != F.col("hub.comp")) & _fits(F.col("n"), F.col("hub.n"), percent))
    counts = met.groupBy("id", F.col("hub.id").alias("hub")).agg(F.count("*").alias("lists"))
    best = counts.groupBy("id").agg(F.max_by("hub", F.struct("lists", -F.col("hub"))).alias("hub"))
    return best.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()


def _parities(heads: DataFrame) -> DataFrame:
    """id and its parity bits p0, p1, …; null where rows of one id have several sets."""
    one = heads.groupBy("id").agg(F.count("*").alias("sets"), F.first("parity").alias("parity"))
    return one.select("id", *[F.when(F.col("sets") == 1, F.get("parity", F.lit(i))).alias(f"p{i}") for i in range(PARITY)])


def _differing() -> Column:
    """Parity bits in which x and y differ; 0 where one has none."""
    bits = [F.bit_count(F.col(f"p{i}_x").bitwiseXOR(F.col(f"p{i}_y"))) for i in range(PARITY)]
    return F.coalesce(reduce(lambda a, b: a + b, bits), F.lit(0))


def _nodes(lists: DataFrame, parities: DataFrame) -> DataFrame:
    """Per document: id, n, merged, comp, parity bits and grams, its lists that hold several components, short lists first.

    Each of grams has the length of the list, the n-gram, and whether the document is of the list's largest component. Sets of
    one id and size are one row.
    """
    sizes = lists.groupBy("gram", "comp").agg(F.count("*").alias("n"))
    of_list = sizes.groupBy("gram").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("major"), F.count("*").alias("comps"), F.sum("n").alias("length"))
    mixed = lists.join(of_list.filter("comps > 1"), "gram")
    entry = F.struct("length", "gram", (F.col("comp") == F.col("major")).alias("is_major"))
    rows = mixed.groupBy("id", "n", "merged", "comp").agg(F.array_sort(F.collect_list(entry)).alias("grams"))
    return rows.join(parities, "id")


def _meetings(nodes: DataFrame, percent: int) -> DataFrame:
    """(x, y): pairs of rows of :func:`_nodes`, as structs of id and n, that may reach the similarity; few rows a pair, not one
    for each list in which it meets.

    Of each list, the documents outside its largest component meet all others; a list within one component meets nothing. A
    pair needs ``least`` common lists, so the first of them has as many places left in both documents' orders, and none of the
    ``BEFORE`` lists before it is common. Both hold for the first common list of every pair.
    """
    # each list with the ones before it: the array of n-grams moved by 1, 2, ...; null where there is none
    moved = [F.slice(F.concat(F.array_repeat(F.lit(None).cast("int"), k), "grams.gram"), F.lit(1), F.size("grams")).alias(f"b{k}") for k in range(1, BEFORE + 1)]
    each = nodes.select("id", "n", "merged", "comp", F.size("grams").alias("among"), F.arrays_zip(F.col("grams").alias("list"), *moved).alias("lists"))
    each = each.select("id", "n", "merged", "comp", "among", F.posexplode("lists").alias("place", "e"))
    before = F.array(*[F.col(f"e.b{k}") for k in range(1, BEFORE + 1)])
    each = each.select("e.list.gram", "e.list.is_major", "id", "n", "merged", "comp", (F.col("among") - F.col("place")).alias("left"), before.alias("before"))
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "merged", "comp", "left", "before")]
    minor = each.filter(~F.col("is_major")).select("gram", *side("x"))
    every = each.select("gram", "is_major", *side("y"))
    once = F.col("is_major") | (F.col("id_x") < F.col("id_y"))
    fits = _fits(F.col("n_x"), F.col("n_y"), percent) & (F.least("left_x", "left_y") >= _least(percent))
    first = ~F.coalesce(F.arrays_overlap("before_x", "before_y"), F.lit(False))
    met = minor.join(every, "gram").filter((F.col("comp_x") != F.col("comp_y")) & once & fits & first)
    x, y = F.struct(F.col("id_x").alias("id"), F.col("n_x").alias("n")), F.struct(F.col("id_y").alias("id"), F.col("n_y").alias("n"))
    return met.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y"))


def _least(percent: int) -> Column:
    """Merged lists in which x and y meet at least if they reach the similarity."""
    return F.greatest(F.lit(1), _overlap(percent) - F.greatest(F.col("n_x") - F.col("merged_x"), F.col("n_y") - F.col("merged_y")))


def _overlap(percent: int) -> Column:
    return F.ceil(F.lit(percent) * (F.col("n_x") + F.col("n_y")) / F.lit(100 + percent))


def _between_components(lists: DataFrame, parities: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of different components that meet in as many merged lists as the similarity asks for, and whose
    parity bits allow it."""
    nodes = store(_nodes(lists, parities))
    met = store(_meetings(nodes, percent).distinct())
    ends = met.select(F.explode(F.array("x.id", "y.id")).alias("id")).distinct()
    rows = nodes.join(ends, "id", "left_semi").withColumn("grams", F.col("grams.gram"))
    side = lambda s: rows.select(F.struct("id", "n").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in rows.columns])
    pairs = met.join(side("x"), "x").join(side("y"), "y")
    # sets of nx and ny elements that share o of them differ in nx + ny - 2 o
    pairs = pairs.filter(_differing() <= F.col("n_x") + F.col("n_y") - 2 * _overlap(percent))
    # n-grams of one document that have the same number count as often as they may be met
    twice = F.least(*[F.size(f"grams_{s}") - F.size(F.array_distinct(f"grams_{s}")) for s in "xy"])
    lists_met = F.size(F.array_intersect("grams_x", "grams_y")) + twice
    return pairs.filter(lists_met >= _least(percent)).select(F.col("id_x").alias("a"), F.col("id_y").alias("b")).distinct()
