"""N-gram Jaccard join: sets of word n-grams that are nearly equal, by prefix filtering.

The n-grams of a set are ordered rare-first by counts over all documents. Two sets whose similarity reaches the threshold
share an n-gram in their prefixes, so the prefix n-grams are joined; length, position and suffix bounds discard pairs that
cannot reach it; the pairs left are verified once on the whole sets. Equal sets are one class and are joined once.

Links serve to find groups, so a pair is not verified where it can add nothing: a first pass verifies neighbours in the
lists only, and the second pass verifies every candidate pair whose groups still differ. A large group of near copies thus
costs a few pairs for each member.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farmledger.llm.components import connected_components
from farmledger.llm.registry import register, table
from farmledger.llm.scratch import keep
from farmledger.llm.textcore import LOWER, NOT_BLANK, mix, ngram_hashes, runs, span_hashes, text_chunks

SIGNED = ["id", "n", "a", "b", "low", "counts"]
COUNTERS_A_ROW = 1 << 14
ODD = ["odd1", "odd2", "odd3", "odd4"]
PARTS = 64  # parts of the hash space whose counts bound the overlap of two sets
EXACT_RANKS = 1 << 15
HOT = 4096  # entries of one n-gram's list in one task, about
COUNTERS = 1 << 22  # counters of n-grams by hash; the order they give is exact for every purpose but speed


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, end to end, and the offsets of the texts in them."""
    data = LOWER[data]
    starts, ends = runs(NOT_BLANK[data], offsets)
    at = np.searchsorted(starts, offsets)
    texts = len(offsets) - 1
    size = np.diff(at)
    owner = np.repeat(np.arange(texts), size)
    words = span_hashes(data, starts, ends)
    grams = ngram_hashes(words, n)
    whole = owner[: len(grams)] == owner[len(words) - len(grams) :]
    values, owners = grams[whole], owner[: len(grams)][whole]
    for k in range(1, n):  # texts of k words are one k-gram
        short = np.flatnonzero(size == k)
        values = np.concatenate([values, mix(ngram_hashes(words, k)[at[short]] + np.uint64(k))]) if len(short) else values
        owners = np.concatenate([owners, short]) if len(short) else owners
    order = np.lexsort((values, owners))
    values, owners = values[order], owners[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
    values, owners = values[new], owners[new]
    return values, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=texts))])


def _signature(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set: equal for equal sets."""
    out = []
    for salt in (1, 2):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix(values * np.uint64(2) + np.uint64(salt)), out=total[1:])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def _keyed(docs: DataFrame, id_col: str, text: str) -> tuple[Column, bool]:
    """A number that stands for each row's document, and whether it is the id itself.

    Where some rows have no id, documents are known by a 64-bit hash of the id, or of the text where there is none.
    """
    number, content = F.col(id_col).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    if docs.where(number.isNull()).isEmpty():
        return number, True
    return F.xxhash64(number.isNull(), number, F.when(number.isNull(), content)), False


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of the frame has."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """16-bit codes in the order of the counts: the count itself below 2^15, beyond it by its logarithm."""
    large = EXACT_RANKS + 600 * np.log2(np.maximum(counts, EXACT_RANKS) / EXACT_RANKS)
    return np.where(counts < EXACT_RANKS, counts, large).astype(np.uint16)


def counts_of(ranks: np.ndarray) -> np.ndarray:
    """The counts that the codes stand for, about."""
    ranks = ranks.astype(np.float64)
    return np.where(ranks < EXACT_RANKS, ranks, EXACT_RANKS * np.exp2((ranks - EXACT_RANKS) / 600))


def jaccard_groups(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text", counters: int = COUNTERS) -> DataFrame:
    """Groups of documents that are linked by word n-gram Jaccard similarity of at least ``percent`` / 100.

    Returns (id_col, n_shingles, component_id), one row for each input row: the size of the document's set and the smallest
    id that is reachable by links. Words are lower-cased (A-Z) runs of non-blank characters; a text of fewer than n words
    is one shingle; a null, empty or blank text has the empty set, which links with nothing, so its group is itself. Rows
    with equal ids are one document, which is linked where any of its texts is; rows without an id are one document for
    each text and are linked like all others; their group is null where no document of it has an id. N-grams are compared
    by 64-bit hashes. Other columns are not read.
    """
    key, given = _keyed(docs, id_col, text)
    groups = _groups(docs.select(key.alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")), n, percent, counters)
    if given:
        return groups.select(F.col("id").alias(id_col), "n_shingles", F.col("component").alias("component_id"))
    named = groups.join(_least_ids(docs, key, id_col, groups), "component", "left").join(_ids(docs, key, id_col), "id", "left")
    return named.select(F.col("number").alias(id_col), "n_shingles", "component_id")


def _ids(docs: DataFrame, key: Column, id_col: str) -> DataFrame:
    return docs.select(key.alias("id"), F.col(id_col).cast("long").alias("number")).where("number IS NOT NULL").distinct()


def _least_ids(docs: DataFrame, key: Column, id_col: str, groups: DataFrame) -> DataFrame:
    """(component, component_id): the smallest id of each group that has one."""
    return groups.select("id", "component").distinct().join(_ids(docs, key, id_col), "id").groupBy("component").agg(F.min("number").alias("component_id"))


def _groups(source: DataFrame, n: int, percent: int, counters: int = COUNTERS) -> DataFrame:
    """(id, n_shingles, component) for the rows (id, text)."""

    # 1. signatures of the sets, and counts of n-grams by counter, in one pass; classes of equal sets
    def signed(batches):
        total = np.zeros(counters, dtype=np.int64)
        for batch, data, offsets in text_chunks(batches, "text"):
            values, at = shingle_sets(data, offsets, n)
            total += np.bincount((values % np.uint64(counters)).astype(np.int64), minlength=counters)
            a, b = _signature(values, at)
            nothing = pa.nulls(len(a), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(at).astype(np.int64)), pa.array(a), pa.array(b), pa.nulls(len(a), pa.int32()), nothing], SIGNED)
        for low in range(0, counters if total.any() else 0, COUNTERS_A_ROW):
            part = zlib.compress(total[low : low + COUNTERS_A_ROW].tobytes(), 1)
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.array([low], pa.int32()), pa.array([part], pa.binary())], SIGNED)

    def summed(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for low, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(zlib.decompress(part), dtype=np.int64)
                sums[low] = sums[low] + counts if low in sums else counts
        if sums:
            parts = [zlib.compress(x.tobytes(), 1) for x in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(parts, pa.binary())], ["low", "counts"])

    both = keep(source.mapInArrow(signed, "id long, n long, a long, b long, low int, counts binary"), "jaccard-signatures")
    sets = both.where("low IS NULL").select("id", "n", "a", "b")
    classes = sets.where("n > 0").groupBy("n", "a", "b").agg(F.min("id").alias("class"))
    rank, every = np.zeros(counters, dtype=np.uint16), 0
    total = both.where("low IS NOT NULL").select("low", "counts").repartition("low").mapInArrow(summed, "low int, counts binary")
    for r in total.toLocalIterator():  # all rows together hold one number for each counter, whatever the corpus
        part = np.frombuffer(zlib.decompress(r.counts), dtype=np.int64)
        rank[r.low : r.low + len(part)] = ranks_of(part)
        every += int(part.sum())
    hot = HOT + 8 * every / counters  # a counter far above the mean may belong to an n-gram of very many sets

    # 2. prefixes of one text of each class: n-grams in order, and what lies behind each in the upper half of the hash space
    def prefixes(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            values, at = shingle_sets(data, offsets, n)
            size = np.diff(at)
            owner = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((values, rank[(values % np.uint64(counters)).astype(np.int64)], owner))
            length = np.where(size > 0, size + (-percent * size) // 100 + 1, 0)
            place = np.flatnonzero(np.arange(len(values)) - at[owner] < length[owner])
            half = np.zeros(len(values) + 1, dtype=np.int64)
            np.cumsum(values[order] >> np.uint64(63), out=half[1:])
            high = half[at[1:]][owner[place]] - half[place + 1]
            cut = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
            chosen = values[order][place]
            grams = pa.ListArray.from_arrays(cut, pa.array(chosen.view(np.int64)))
            counted = counts_of(rank[(chosen % np.uint64(counters)).astype(np.int64)])
            tasks = pa.ListArray.from_arrays(cut, pa.array(np.where(counted > hot, counted // HOT + 1, 1).astype(np.int32)))
            behind = pa.ListArray.from_arrays(cut, pa.array(high.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_signature(values, at)[0]), pa.array(size.astype(np.int32)), grams, behind, tasks], ["class", "a", "size", "grams", "behind", "tasks"])

    leaders = classes.where("class IS NOT NULL").select("class", "a")
    lists = source.where("id IS NOT NULL").mapInArrow(prefixes, "class long, a long, size int, grams array<long>, behind array<int>, tasks array<int>")
    flat = lists.join(leaders, ["class", "a"], "left_semi").select("class", "size", F.pmod("a", F.lit(251)).cast("short").alias("tag"), F.posexplode(F.arrays_zip("grams", "behind", "tasks")).alias("position", "g"))
    index = flat.select(F.col("g.grams").alias("gram"), "class", "size", "tag", "position", F.col("g.behind").alias("high"), F.col("g.tasks").alias("tasks"))
    # an n-gram of one set links nothing; the list of a very frequent one is dealt to several tasks and stays whole
    index = index.withColumn("salt", F.when(F.col("tasks") > 1, F.pmod(F.xxhash64("gram", "class"), "tasks").cast("int")).otherwise(0))
    index = index.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("gram", "salt"))).where("df > 1 OR tasks > 1").drop("df", "tasks")
    filtered = keep(index, "jaccard-prefixes")

    # 3. the texts of the sets that share a prefix n-gram with another one
    partners = filtered.select(F.col("class").alias("id")).distinct()

    def described(batches):
        for batch, data, offsets in text_chunks(batches, "text"):
            values, at = shingle_sets(data, offsets, n)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
            parts = np.bincount(owner * PARTS + (values >> np.uint64(58)).astype(np.int64), minlength=batch.num_rows * PARTS)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(parts) + 1, PARTS, dtype=np.int32)), pa.array(parts.astype(np.int32)))
            odd = np.bincount(owner * 256 + (values & np.uint64(255)).astype(np.int64), minlength=batch.num_rows * 256) & 1
            odd = np.packbits(odd.astype(np.uint8)).view(np.int64).reshape(-1, 4)
            tag = pa.array((_signature(values, at)[0] % 251).astype(np.int16))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tag, lists, *(pa.array(odd[:, k]) for k in range(4))], ["class", "text", "tag", "parts", *ODD])

    texts = source.join(partners, "id", "left_semi").select("id", "text").mapInArrow(
        described, "class long, text string, tag short, parts array<int>, " + ", ".join(f"{o} long" for o in ODD)
    )
    texts = keep(texts, "jaccard-texts")
    # with each n-gram: the two before it in its list (a pair that shares one of them is met there already), and which of
    # 256 parts of the hash space hold an odd number of the set (two sets differ in as many n-grams as in these bits, or more)
    line = Window.partitionBy("class", "size", "tag").orderBy("position")  # one text of an id that has several
    index = filtered.join(texts.select("class", "tag", *ODD).dropDuplicates(["class", "tag"]), ["class", "tag"])
    index = index.withColumns({"before1": F.lag("gram", 1).over(line), "before2": F.lag("gram", 2).over(line)}).drop("tag")
    index = keep(index, "jaccard-index")

    # 4. neighbours in the lists, by size and by hash
    spread = index.select("gram", "class", "size", "salt")
    by_size = Window.partitionBy("gram", "salt").orderBy("size", "class")
    by_hash = Window.partitionBy("gram", "salt").orderBy(F.xxhash64("class"), "class")
    beside = {f"{c}{k}": F.lag(c).over(w) for k, w in enumerate((by_size, by_hash)) for c in ("class", "size")}
    pairs = F.array(*[F.struct(F.col(f"class{k}").alias("class"), F.col(f"size{k}").alias("size")) for k in (0, 1)])
    met = spread.withColumns(beside).select("class", "size", F.explode(pairs).alias("o")).where(
        F.least("size", "o.size") * 100 >= F.greatest("size", "o.size") * percent
    )
    likely = met.where("class <> o.class").select(F.least("class", "o.class").alias("x"), F.greatest("class", "o.class").alias("y")).distinct()
    links = keep(verified(likely, texts, n, percent), "jaccard-links")
    group = keep(connected_components(links, "x", "y"), "jaccard-groups")

    # 5. every candidate pair between different groups
    lists = _grouped(index, group).withColumn("low", F.col("size") - F.col("position") - 1 - F.col("high"))
    # a group counts once under an n-gram, with bounds for its members: pairs inside a group are not formed
    bounds = [F.count(F.lit(1)).alias("members"), F.min("size").alias("least_size"), F.max("size").alias("most_size"), *[F.max(c).alias(f"most_{c}") for c in ("position", "high", "low")]]
    same = [F.when((F.count(c) == F.count(F.lit(1))) & (F.min(c) == F.max(c)), F.min(c)).alias(c) for c in ("before1", "before2")]
    bits = [f(o).alias(f"{name}_{o}") for o in ODD for name, f in (("all", F.bit_and), ("any", F.bit_or))]
    entries = lists.groupBy("gram", "grp").agg(*bounds, *same, *bits)
    differ = F.lit(0)
    for o in ODD:
        apart = [F.col(f"{x}.all_{o}").bitwiseAND(F.bitwise_not(F.col(f"{y}.any_{o}"))) for x, y in ("lr", "rl")]
        differ = differ + F.bit_count(apart[0].bitwiseOR(apart[1]))
    total = F.col("l.least_size") + F.col("r.least_size")
    meet = entries.alias("l").join(
        entries.alias("r"),
        (F.col("l.gram") == F.col("r.gram")) & (F.col("l.grp") < F.col("r.grp")) & _alike("least_size", "most_size", percent)
        & _reach(total, percent, "most_position", "most_high", "most_low") & _first_met() & (differ * (100 + percent) <= (F.col("l.most_size") + F.col("r.most_size")) * (100 - percent)),
    )
    # the smaller group's members are listed, then met with the other's: a row for each of the smaller side
    smaller = F.col("l.members") <= F.col("r.members")
    two = [F.when(smaller, F.col(f"{x}.grp")).otherwise(F.col(f"{y}.grp")).alias(name) for x, y, name in (("l", "r", "grp"), ("r", "l", "other"))]
    meet = keep(meet.select("l.gram", *two), "jaccard-meet")
    left, right = meet.join(lists, ["gram", "grp"]).alias("l"), lists.alias("r")
    differ = F.lit(0)
    for o in ODD:
        differ = differ + F.bit_count(F.col(f"l.{o}").bitwiseXOR(F.col(f"r.{o}")))
    total = F.col("l.size") + F.col("r.size")
    pairs = left.join(
        right,
        (F.col("l.gram") == F.col("r.gram")) & (F.col("l.other") == F.col("r.grp")) & _alike("size", "size", percent)
        & _reach(total, percent, "position", "high", "low") & _first_met() & (differ <= total - 2 * F.ceil(F.lit(percent) * total / F.lit(100 + percent))),
    ).select(F.least("l.class", "r.class").alias("x"), F.greatest("l.class", "r.class").alias("y")).distinct()
    more = keep(verified(pairs, texts, n, percent), "jaccard-links")
    # an id with several texts ties the classes of its texts together
    several = sets.where("id IS NOT NULL AND n > 0").groupBy("id").agg(F.min("a").alias("least"), F.max("a").alias("most")).where("least <> most")
    ties = sets.join(several.select("id"), "id").join(classes, ["n", "a", "b"]).select(F.col("id").alias("x"), F.col("class").alias("y"))
    # the groups themselves are the nodes now, so a large group counts once
    ends = more.unionByName(ties)
    for side in ("x", "y"):
        named = group.select(F.col("node").alias(side), F.col("component").alias(f"{side}_group"))
        ends = ends.join(named, side, "left").withColumn(f"{side}_group", F.coalesce(f"{side}_group", side))
    joined = connected_components(ends.select("x_group", "y_group").distinct(), "x_group", "y_group")
    joined = joined.select(F.col("node").alias("g"), F.col("component").alias("last"))
    # a class that is no node of the first graph may be one of the second
    known = group.unionByName(joined.join(group, F.col("g") == F.col("node"), "left_anti").select(F.col("g").alias("node"), F.col("g").alias("component")))
    final = known.join(joined, F.col("component") == F.col("g"), "left").select("node", F.coalesce("last", "component").alias("component"))

    # 6. back to the documents: the texts of an id meet in its group
    by_class = classes.join(final, classes["class"] == final["node"], "left").select("n", "a", "b", F.coalesce("component", "class").alias("component"))
    named = sets.join(by_class, ["n", "a", "b"], "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
    return named.select("id", "n_shingles", "component")


def _alike(least: str, most: str, percent: int) -> Column:
    """Sizes that allow the similarity."""
    return (F.col(f"l.{most}") * 100 >= F.col(f"r.{least}") * percent) & (F.col(f"r.{most}") * 100 >= F.col(f"l.{least}") * percent)


def _reach(total: Column, percent: int, position: str, high: str, low: str) -> Column:
    """n-grams before this one at most, this one, and at most what the halves of the suffixes have in common, are enough."""
    common = [F.least(f"l.{c}", f"r.{c}") for c in (position, high, low)]
    return common[0] + 1 + common[1] + common[2] >= F.ceil(F.lit(percent) * total / F.lit(100 + percent))


def _first_met() -> Column:
    """Neither of the two n-grams before this one is shared: such a pair is met there already."""
    new = F.lit(True)
    for a in ("before1", "before2"):
        for b in ("before1", "before2"):
            new = new & F.coalesce(F.col(f"l.{a}") != F.col(f"r.{b}"), F.lit(True))
    return new


def _grouped(lists: DataFrame, group: DataFrame) -> DataFrame:
    """The rows with the group of their class; a class without links is its own group."""
    named = group.select(F.col("node").alias("class"), F.col("component").alias("_group"))
    return lists.join(named, "class", "left").withColumn("grp", F.coalesce("_group", "class")).drop("_group")


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (x, y) whose sets reach the threshold; each pair is looked at once, on whole texts."""

    def check(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                keys, owners, sizes = [], [], []
                for column in (2, 3):
                    found = np.zeros(0, dtype=np.int64)
                    first = 0
                    for rows, data, offsets in text_chunks([part.select([column]).rename_columns(["text"])], "text"):
                        values, at = shingle_sets(data, offsets, n)
                        owner = np.repeat(np.arange(rows.num_rows) + first, np.diff(at))
                        keys.append(mix(values + mix(owner.astype(np.uint64))))
                        owners.append(owner)
                        found = np.concatenate([found, np.diff(at)])
                        first += rows.num_rows
                    sizes.append(found)
                key, owner = np.concatenate(keys), np.concatenate(owners)
                order = np.argsort(key)
                same = key[order[1:]] == key[order[:-1]]
                common = np.bincount(owner[order[1:][same]], minlength=part.num_rows)
                good = common * 100 >= (sizes[0] + sizes[1] - common) * percent
                yield part.select([0, 1]).filter(pa.array(good))

    # sets overlap no more than their counts do in each part of the hash space
    def side(name: str, column: str) -> DataFrame:
        return texts.select(F.col("class").alias(name), F.col(column).alias(f"{name}_{column}"))

    bounded = pairs.join(side("x", "parts"), "x").join(side("y", "parts"), "y")
    zero = F.lit(0)
    common = F.aggregate(F.zip_with("x_parts", "y_parts", lambda a, b: F.least(a, b)), zero, lambda acc, v: acc + v)
    total = F.aggregate("x_parts", zero, lambda acc, v: acc + v) + F.aggregate("y_parts", zero, lambda acc, v: acc + v)
    pairs = bounded.where(common * 100 >= (total - common) * percent).select("x", "y").distinct()
    both = pairs.join(texts.select(F.col("class").alias("x"), F.col("text").alias("x_text")), "x")
    both = both.join(texts.select(F.col("class").alias("y"), F.col("text").alias("y_text")), "y")
    return both.select("x", "y", "x_text", "y_text").mapInArrow(check, "x long, y long")


def one_of_each_group(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest id of their group, with all their columns; repeated rows stay once.

    A group without any id keeps one of its texts; a document without an id goes if its group has one with an id.
    """
    key, given = _keyed(docs, id_col, text)
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    groups = _groups(docs.select(key.alias("id"), content.alias("text")), n, percent)
    if given:
        first = groups.where("id = component").select("id").distinct()
    else:  # the smallest id of the group, or the smallest key where it has none
        groups = keep(groups.select("id", "component").distinct(), "jaccard-keys")
        least = groups.join(_ids(docs, key, id_col), "id", "left").groupBy("component").agg(F.min(F.struct(F.col("number").isNull(), "number", "id")).alias("least"))
        first = least.select("least.id")
    chosen, copy, content_hash = _free(docs, "_key", "_copy", "_content")
    kept = docs.withColumn(chosen, key).join(first.withColumnRenamed("id", chosen), chosen, "left_semi")
    same = Window.partitionBy(chosen, content_hash).orderBy(F.lit(1))
    kept = kept.withColumn(content_hash, F.xxhash64(content)).withColumn(copy, F.row_number().over(same)).where(F.col(copy) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


@register("op2_ngram_jaccard_join")
def op2_ngram_jaccard_join(spark: SparkSession, directory: str) -> DataFrame:
    """All documents grouped by three-word shingles at a similarity of 0.9."""
    return jaccard_groups(table(spark, directory, "documents"), n=3, percent=90)
