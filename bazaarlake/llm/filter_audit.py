"""What every filter of a chain removes, in every order the chain can have.

1. A task inserts its texts into a radix trie. Copies meet there: a text's filters
   are decided once, and of its rows only those with its smallest id go on with the
   text; the others are known copies. A group of copies of any size thus gives each
   task one text.
2. Those texts are range-partitioned by prefixes that adapt to them: a prefix that
   holds too many bytes of distinct texts is lengthened until it does not.
3. Each range inserts its full texts into tries whose terminals hold the smallest id,
   and a traversal flags the rows whose id is larger.
4. Rows become counts per source and set of failed filters. These few cells answer
   all orders, steps and Shapley values.

Failed filters are a string of their letters, in alphabetical order.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import binaries, session_for, written
from bazaarlake.llm.tries import Trie

LETTERS = "ABCDE"
COPY = "E"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_CONTINUED = bytes(range(0x80, 0xC0))  # of UTF-8: all bytes of a character but its first


@dataclass(frozen=True)
class Settings:
    """A: fewer than ``words`` words. B: fewer than ``distinct`` percent of them distinct.
    C: more than ``capitals`` percent of the characters are A-Z. D: any of ``symbols``.
    E: the text of a smaller id.

    ``trie_bytes`` bounds the texts a trie holds and those under one prefix (more only
    if they are one text), ``trie_rows`` its rows. A prefix has ``prefix`` characters,
    ``longer`` times as many whenever it is lengthened."""

    words: int = 50
    distinct: int = 65
    capitals: int = 5
    symbols: bytes = b"#$%&*|"
    trie_bytes: int = 16 << 20
    trie_rows: int = 100_000
    prefix: int = 16
    longer: int = 4


def failed(text: bytes, rules: Settings) -> str:
    """Letters of the filters A to D that a text fails."""
    tokens = text.split()  # bytes: at ASCII white space
    count = len(tokens)
    out = "A" if count < rules.words else ""
    if 100 * len(set(tokens)) < rules.distinct * count:
        out += "B"
    points = len(text.translate(None, _CONTINUED))
    if 100 * (len(text) - len(text.translate(None, _CAPITALS))) > rules.capitals * points:
        out += "C"
    if len(text.translate(None, rules.symbols)) < len(text):
        out += "D"
    return out


def _table(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names=names
    )


def _per_task(slim: DataFrame, rules: Settings) -> DataFrame:
    """``id part fails n text``: rows of known copies lack ``text``."""
    names = ["id", "part", "fails", "n", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, kinds = Trie(), None

        def flush() -> Iterator[pa.RecordBatch]:
            out, size = [], 0
            for text, place in trie.terminals():
                fails, kept = place.value, {}
                for ident, part in place.rows:
                    if ident is None or ident > place.least:
                        out.append((ident, part, fails + COPY * (ident is not None), 1, None))
                    else:
                        kept[part] = kept.get(part, 0) + 1
                for part, n in kept.items():
                    out.append((place.least, part, fails, n, text.decode()))
                    size += len(text)
                if size > 4 << 20 or len(out) > 10_000:
                    yield _table(out, kinds, names)
                    out, size = [], 0
            if out:
                yield _table(out, kinds, names)

        for batch in batches:
            kinds = [batch.column("id").type, pa.string(), pa.string(), pa.int64(), pa.string()]
            ids, parts = batch.column("id").to_pylist(), batch.column("part").to_pylist()
            for ident, part, text in zip(ids, parts, binaries(batch, "text")):
                place = trie.insert(text)
                if place.value is None:
                    place.value = failed(text, rules)
                place.add(ident, part)
            if trie.bytes > rules.trie_bytes or trie.rows > rules.trie_rows:
                yield from flush()
                trie = Trie()
        if trie.rows:
            yield from flush()

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, part string, fails string, n bigint, text string")


def _keyed(texts: DataFrame, rules: Settings) -> DataFrame:
    """``texts`` with ``key``: the shortest prefix that holds few enough bytes of distinct texts.

    Every round looks at the texts under prefixes that were too heavy before. Their
    number is at most that of all bytes over the bound, so the table of them is small
    beside the texts; Spark broadcasts it by its measured size.
    """
    spark = texts.sparkSession
    size = F.octet_length("text").cast("bigint")
    total = texts.agg(F.sum(size)).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bound = max(1, min(rules.trie_bytes, total // (2 * parts)))
    length = rules.prefix
    keyed = texts.withColumn("key", F.substring("text", 1, length))
    open_ = keyed
    while True:
        heavy = (
            open_.groupBy("key", F.xxhash64("text").alias("text"))
            .agg(F.max(size).alias("size"))
            .groupBy("key")
            .agg(F.sum("size").alias("size"), F.count("*").alias("texts"))
            .filter((F.col("size") > bound) & (F.col("texts") > 1))
            .select(F.col("key").alias("heavy"))
        )
        heavy = written(heavy, "heavy_prefixes")
        if heavy.isEmpty():
            return keyed
        length *= rules.longer
        longer = F.substring("text", 1, length)
        keyed = keyed.join(heavy, F.col("key") == F.col("heavy"), "left").withColumn(
            "key", F.when(F.col("heavy").isNotNull(), longer).otherwise(F.col("key"))
        ).drop("heavy")
        open_ = keyed.filter(F.char_length("key") > length // rules.longer)


def _flagged(keyed: DataFrame, rules: Settings) -> DataFrame:
    """``id part fails n`` of rows with texts, copies of smaller ids among them flagged."""
    names = ["id", "part", "fails", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, last, kinds = Trie(), None, None

        def flush() -> Iterator[pa.RecordBatch]:
            out = []
            for _, place in trie.terminals():
                for ident, (part, fails, n) in place.rows:
                    out.append((ident, part, fails + COPY * (ident > place.least), n))
                if len(out) > 10_000:
                    yield _table(out, kinds, names)
                    out = []
            if out:
                yield _table(out, kinds, names)

        for batch in batches:
            kinds = [batch.column("id").type, pa.string(), pa.string(), pa.int64()]
            columns = [batch.column(c).to_pylist() for c in ("key", "id", "part", "fails", "n")]
            for key, ident, part, fails, n, text in zip(*columns, binaries(batch, "text")):
                if key != last and (trie.bytes > rules.trie_bytes or trie.rows > rules.trie_rows):
                    yield from flush()
                    trie = Trie()
                last = key
                trie.insert(text).add(ident, (part, fails, n))
        if trie.rows:
            yield from flush()

    kind = keyed.schema["id"].dataType.simpleString()
    ranges = keyed.repartitionByRange("key").sortWithinPartitions("key")
    return ranges.mapInArrow(run, f"id {kind}, part string, fails string, n bigint")


def failures(
    docs: DataFrame,
    rules: Settings = Settings(),
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``id part fails n``: the documents of a part with that id and those failures are ``n``.

    NULL text is an empty text, a NULL source the part ''. A NULL id is larger than no
    id and smaller than none. Rows repeated under one id are no copies of each other.
    No rows give none.
    """
    session_for(docs)
    slim = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("part"),
        F.col(f"`{text_col}`").alias("text"),
    )
    rows = written(_per_task(slim, rules), "per_task")
    known = rows.filter("text IS NULL").drop("text")
    texts = written(_flagged(_keyed(rows.filter("text IS NOT NULL"), rules), rules), "flagged")
    return known.unionByName(texts)


def cells(
    failed_rows: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
) -> DataFrame:
    """``part fails n good toxic``: counts of documents, of those labelled quality 1 and toxic 1.

    Several labels of one id count as one: any 1 of them decides. Rows of one id are
    summed before the join, so an id may have any number of them.
    """
    flags = labels.groupBy(F.col(f"`{id_col}`").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"),
    )
    summed = failed_rows.groupBy("id", "part", "fails").agg(F.sum("n").alias("n"))
    n = F.col("n")
    return (
        summed.join(flags, "id", "left")
        .groupBy("part", "fails")
        .agg(
            F.sum("n").alias("n"),
            F.sum(n * F.coalesce("good", F.lit(0))).alias("good"),
            F.sum(n * F.coalesce("toxic", F.lit(0))).alias("toxic"),
        )
    )


def _total(cell_array: Column, measure: str, wanted) -> Column:
    some = F.filter(cell_array, wanted)
    return F.aggregate(some, F.lit(0).cast("bigint"), lambda acc, c: acc + c[measure])


def report(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """``part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley``.

    One row per part, order of the filters and step, zeros included. A document that
    fails k filters is removed by each of them in one k-th of all orders: that is its
    part of ``shapley``, the sum of ``removed`` of the step's filter over all orders.
    """
    orders = ["".join(p) for p in itertools.permutations(letters)]
    by_part = counts.groupBy("part").agg(
        F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells")
    )
    steps = (
        by_part.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
        .withColumn("letter", F.expr("substring(filter_order, step, 1)"))
        .withColumn("earlier", F.expr("substring(filter_order, 1, step - 1)"))
    )
    fails, inside = F.col("letter"), F.col("cells")

    def hit(c: Column) -> Column:
        return F.contains(c["fails"], fails)

    def passed(c: Column) -> Column:
        return F.call_function("translate", c["fails"], F.col("earlier"), F.lit("")) == c["fails"]

    def removed(c: Column) -> Column:
        return hit(c) & passed(c)

    weighted = F.aggregate(
        F.filter(inside, hit),
        F.lit(0).cast("bigint"),
        lambda acc, c: acc + c["n"] * F.call_function("div", F.lit(len(orders)), F.length(c["fails"])),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        _total(inside, "n", lambda c: passed(c) & ~hit(c)).alias("kept"),
        _total(inside, "n", removed).alias("removed"),
        _total(inside, "n", lambda c: hit(c) & ~passed(c)).alias("redundant"),
        _total(inside, "n", lambda c: c["fails"] == fails).alias("unique_fails"),
        _total(inside, "good", removed).alias("good_lost"),
        _total(inside, "toxic", removed).alias("toxic_lost"),
        weighted.alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    rules: Settings = Settings(),
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``report`` of the five filters over all documents."""
    return report(cells(failures(docs, rules, id_col, source_col, text_col), labels, id_col))
