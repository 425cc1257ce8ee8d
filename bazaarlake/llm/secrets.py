"""Secret scan: wide candidates, then a random forest against false positives.

Candidates are all long runs of code-like characters, and shorter ones that a
credential's name is assigned to. Their length, changes of
character class, dictionary coverage, path context and neighbouring words go to a
random forest trained on labelled findings. Everything runs as DataFrame and ML
expressions in the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import let, words, written
from bazaarlake.session import tune

RUN = "[A-Za-z0-9_+/=-]"
FEATURES = [
    "length",
    "transitions",
    "digit_share",
    "distinct_share",
    "coverage",
    "in_path",
    "assigned",
    "quoted",
    "credential_word",
    "placeholder_word",
]
_CREDENTIAL = "(?i)(token|secret|passw|pwd|api.?key|access.?key|credential|auth|bearer)"
#: Between a name and what is assigned to it; also over word breaks.
_ASSIGN = "[\"'`]?\\s{0,3}(:|=)[:=>]{0,2}\\s{0,3}[\"'`]{0,3}"
#: Characters that end a field of JSON, CSV or a URL's query.
_FIELD = "?&#,;(){}\\[\\]"
_PLACEHOLDER = "(?i)(?<![a-z])(example|sample|dummy|placeholder|your|test|fake|changeme)(?![a-z])|xxxx"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def candidates(
    docs: DataFrame,
    shortest: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest_named: int = 6,
) -> DataFrame:
    """``id place offset finding before prefix suffix next``: a row per code-like run.

    A run has ``shortest`` characters, or ``shortest_named`` if a credential's name is
    assigned to it. ``place`` is the word's number in the text, ``offset`` the run's
    in the word; prefix and suffix are the rest of the word. NULL text has none.
    """
    named = f"{_CREDENTIAL}[A-Za-z0-9_.-]*{_ASSIGN}"

    def before(tokens: Column, at: Column) -> Column:
        return F.concat_ws(" ", F.get(tokens, at - 3), F.get(tokens, at - 2), F.get(tokens, at - 1))

    def found(tokens: Column) -> Column:
        def one(word: Column, at: Column) -> Column:
            long = (F.length(word) >= shortest) & word.rlike(f"{RUN}{{{shortest}}}")
            left = F.concat_ws(" ", before(tokens, at), word)
            short = F.col("names") & (F.length(word) >= shortest_named) & left.rlike(f"{named}{RUN}{{{shortest_named}}}")
            return F.when(
                long | short,
                F.struct(
                    at.alias("place"),
                    word.alias("word"),
                    before(tokens, at).alias("before"),
                    F.coalesce(F.get(tokens, at + 1), F.lit("")).alias("next"),
                ),
            )

        return F.filter(F.transform(tokens, one), lambda x: x.isNotNull())

    def runs(pieces: Column) -> Column:
        def one(piece: Column, at: Column) -> Column:
            def joined(start: Column | int, size: Column) -> Column:
                return F.array_join(F.slice(pieces, start, size), "")

            prefix = joined(1, at)
            # A short run that holds its own name, as in password=..., is cut to the value.
            own = F.when(
                F.length(piece) < shortest, F.regexp_extract(piece, f"^[A-Za-z0-9_-]*?{_CREDENTIAL}[A-Za-z0-9_-]*=+", 0)
            ).otherwise("")
            value = F.substring(piece, F.length(own) + 1, F.length(piece))
            left = F.concat_ws(" ", "before", F.concat(prefix, own))
            wanted = (F.length(piece) >= shortest) | (
                (F.length(value) >= shortest_named) & left.rlike(f"{named}$")
            )
            return F.when(
                wanted & piece.rlike(f"^{RUN}"),
                F.struct(
                    (F.length(prefix) + F.length(own)).alias("offset"),
                    value.alias("finding"),
                    F.concat(prefix, own).alias("prefix"),
                    joined(at + 2, F.size(pieces)).alias("suffix"),
                ),
            )

        return F.filter(F.transform(pieces, one), lambda x: x.isNotNull())

    text = F.col(f"`{text_col}`")
    return (
        docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
        .withColumn("names", F.col("text").rlike(named))
        .filter(F.col("names") | F.col("text").rlike(f"{RUN}{{{shortest}}}"))
        .select("id", F.explode(let(words("text"), found)).alias("c"))
        .select("id", "c.*")
        .withColumn("r", F.explode(let(F.split("word", f"(?<={RUN})(?!{RUN})|(?<!{RUN})(?={RUN})", -1), runs)))
        .select("id", "place", "before", "next", "r.*")
    )


def dictionary(docs: DataFrame, size: int = 400, shortest: int = 4, text_col: str = "text") -> list[str]:
    """The most frequent all-letter words of at least ``shortest`` letters.

    Counted over all texts; ``size`` of them come to the driver.
    """
    plain = F.filter(words(F.lower(F.col(f"`{text_col}`"))), lambda w: w.rlike(f"^[a-z]{{{shortest},}}$"))
    counted = docs.select(F.explode(plain).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    return [r["w"] for r in counted.orderBy(F.desc("n"), "w").limit(size).collect()]


def featured(found: DataFrame, known: list[str]) -> DataFrame:
    """The candidates with the numeric features."""
    run = F.col("finding")
    size = F.length(run)
    kinds = F.translate(
        F.translate(
            F.translate(run, _LOWER, "a" * 26), _LOWER.upper(), "A" * 26
        ),
        "0123456789",
        "0" * 10,
    )
    digits = size - F.length(F.translate(run, "0123456789", ""))
    # Longer words first, so that one covers as much as it can.
    pattern = "|".join(sorted(known, key=lambda w: (-len(w), w)))
    bare = F.regexp_replace(F.lower(run), pattern, "") if known else run
    # Of the run's word only the field around the run; words before only if they border on it.
    field = F.regexp_extract("prefix", f"[^{_FIELD}]*$", 0)
    name = F.regexp_extract("finding", "^[A-Za-z][A-Za-z0-9_-]*=+(?=.)", 0)
    left = F.concat_ws(
        " ", F.when(F.length("prefix") - F.length(field) <= 2, F.col("before")), F.concat(field, name)
    )
    found = found.withColumns(
        {
            "around": F.concat(field, "finding", F.regexp_extract("suffix", f"^[^{_FIELD}]*", 0)),
            "left": left,
        }
    )
    return found.withColumns(
        {
            "length": size.cast("double"),
            "transitions": (F.length(F.regexp_replace(kinds, "(.)\\1+", "$1")) - 1).cast("double"),
            "digit_share": digits / size,
            "distinct_share": F.size(F.array_distinct(F.split(run, ""))) / size,
            "coverage": (size - F.length(bare)) / size,
            "in_path": F.col("around").rlike("://|(^|[^A-Za-z0-9+=])/|[.][a-z]{2,4}$|/.*/.*/").cast("double"),
            "assigned": F.col("left").rlike("[=:]").cast("double"),
            "quoted": F.col("prefix").rlike("[\"'`]$").cast("double"),
            "credential_word": F.col("left").rlike(_CREDENTIAL).cast("double"),
            "placeholder_word": F.col("around").rlike(_PLACEHOLDER).cast("double"),
        }
    )


def weak_labels(found: DataFrame) -> DataFrame:
    """Labels where a finding's surroundings leave no doubt, for want of reviewed ones.

    1: a run with digits assigned to a credential's name, no placeholder in its field.
    0: a run of letters alone, in a path, or with a placeholder in its field.
    A run that is both assigned to a credential's name and with a placeholder has none.
    """
    sure = (F.col("credential_word") == 1) & (F.col("assigned") == 1) & (F.col("digit_share") > 0.1)
    placeholder = F.col("placeholder_word") == 1
    harmless = (F.col("digit_share") == 0) | (F.col("in_path") == 1) | (placeholder & ~sure)
    label = F.when(harmless, 0.0).when(sure & ~placeholder, 1.0)
    return found.withColumn("label", label).filter("label is not null")


def scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    most_labelled: int = 20_000,
    trees: int = 20,
    depth: int = 6,
    keep_from: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id place offset finding`` with the features, ``probability`` and ``kept``.

    ``labelled`` has FEATURES and ``label`` (0 or 1), such as reviewed findings of
    an earlier scan; without it weak labels of this scan are used. Equal ones count
    once. The forest is fitted on at most ``most_labelled`` of them, half of either
    label where there are enough, chosen by a hash of the features; every candidate is
    scored. Should the labels be all alike, that is the verdict
    on every candidate; without any, all are kept.

    NULL text has no candidates; a NULL id is kept; repeated rows and findings are
    scored each; no rows give none.
    """
    tune(docs.sparkSession)
    # Written once: it is read for labels and for scores.
    found = written(
        featured(candidates(docs, id_col=id_col, text_col=text_col), dictionary(docs, text_col=text_col)),
        "candidates",
    )
    known = weak_labels(found) if labelled is None else labelled
    # A finding repeated any number of times is one row, so it cannot fill the sample.
    once = known.select(*FEATURES, F.col("label").cast("double").alias("label")).distinct()
    each = [
        once.filter(F.col("label") == kind).orderBy(F.xxhash64(*FEATURES)).limit(most)
        for kind, most in ((0.0, most_labelled // 2), (1.0, most_labelled - most_labelled // 2))
    ]
    sample = written(each[0].unionByName(each[1]), "labelled")
    kinds = [r["label"] for r in sample.select("label").distinct().orderBy("label").collect()]
    columns = ["id", "place", "offset", "finding", *FEATURES]
    if len(kinds) < 2:
        verdict = F.lit(float(kinds[0]) if kinds else 1.0)
        scored = found.select(*columns, verdict.alias("probability"))
    else:
        to_vector = VectorAssembler(inputCols=FEATURES, outputCol="features")
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17)
        model = forest.fit(to_vector.transform(sample))
        scored = model.transform(to_vector.transform(found)).select(
            *columns, vector_to_array("probability")[1].alias("probability")
        )
    return scored.withColumn("kept", F.col("probability") >= keep_from)
