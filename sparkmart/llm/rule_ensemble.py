"""Operator 10: a quality classifier as a sparse ensemble of rules.

Statistics of a whole text are Spark expressions.  A random forest over labelled rows
gives paths; every path from a root, and every beginning of one, is a conjunctive rule.  A
logistic regression with lasso penalty gives most rules no weight; those with one are
compiled into a single column expression, so scoring is one scan without Python or joins.

The classifier is fitted on at most ``SAMPLE_ROWS`` labelled rows, chosen by a hash of
``doc_id`` - a parameter; scores are computed for all rows.  Labels, language, source and
ids are no inputs of a score.  NULL and empty texts have statistics of zero and a score.
Rows labelled more than once count once per label; without labels every score is 0.5, and
with labels of one kind the share of it, smoothed.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm.common import cut, held_out, words

SAMPLE_ROWS = 20_000
TREES, DEPTH, SEED = 16, 3, 42
LASSO, ITERATIONS = 0.001, 60
THRESHOLD = 0.7

SYMBOLS, DIGITS, STOPS = "#*$%&<>@^~=+_\\/{}[]", "0123456789", ".,;:?"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÄÅÆÇÈÉÊËÌÍÎÏÑÒÓÔÖØÙÚÛÜ"
FEATURES = (
    "log_words", "word_length", "symbol_share", "bar_share", "exclaim_share", "digit_share", "capital_share",
    "stop_share", "line_words", "distinct_share", "repeat_share",
)


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the columns of :data:`FEATURES`; all are shares or means, bounded for any length of text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumn("_words", words(F.col(text)))
    repeats = F.aggregate("_words", F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("w")), lambda s, w: F.struct(
        (s["n"] + s["w"].eqNullSafe(w).cast("int")).alias("n"), w.alias("w")), lambda s: s["n"])
    n, size = F.size("_words"), F.length(whole)
    return split.withColumns({
        "log_words": F.log1p(n.cast("double")),
        "word_length": _share(size, n),
        "symbol_share": _share(_count(whole, SYMBOLS), n),
        "bar_share": _share(_count(whole, "|"), n),
        "exclaim_share": _share(_count(whole, "!"), n),
        "digit_share": _share(_count(whole, DIGITS), size),
        "capital_share": _share(_count(whole, CAPITALS), size),
        "stop_share": _share(_count(whole, STOPS), n),
        "line_words": _share(n, F.lit(1) + _count(whole, "\n")),
        "distinct_share": _share(F.size(F.array_distinct("_words")), n),
        "repeat_share": _share(repeats, n),
    }).drop("_words")


#: A rule: (feature, at most or above, bound), all of which must hold.
Rule = tuple[tuple[str, bool, float], ...]
_LINE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(debug: str, features: tuple[str, ...] = FEATURES) -> list[Rule]:
    """All beginnings of the paths of a tree as Spark prints it."""
    rules, path = [], []
    for line in debug.splitlines():
        if m := _LINE.match(line):
            path = [c for c in path if c[0] < len(m[1])]
            path.append((len(m[1]), (features[int(m[2])], m[3] == "<=", float(m[4]))))
            rules.append(tuple(condition for _, condition in path))
    return rules


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(name) <= bound if below else F.col(name) > bound for name, below, bound in rule])


def fit(sample: DataFrame) -> Column:
    """The score as an expression over :data:`FEATURES`; ``sample`` has them and ``label``."""
    kinds = {row["label"]: row["count"] for row in sample.groupBy("label").count().collect()}
    if len(kinds) < 2:
        total = sum(kinds.values())
        return F.lit((kinds.get(1, 0) + 0.5) / (total + 1) if total else 0.5)
    points = sample.select(F.col("label").cast("double"), array_to_vector(F.array(*FEATURES)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5").fit(points)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    marked = sample.select(F.col("label").cast("double"), array_to_vector(F.array(*[holds(r).cast("double") for r in rules])).alias("features"))
    model = LogisticRegression(regParam=LASSO, elasticNetParam=1.0, maxIter=ITERATIONS).fit(cut(marked, "rules"))
    terms = [F.when(holds(r), F.lit(float(w))).otherwise(F.lit(0.0)) for r, w in zip(rules, model.coefficients, strict=True) if w]
    return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(float(model.intercept)))))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and ``label`` of at most ``rows`` labelled rows that are not held out."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", F.col("quality").alias("label")).distinct()
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows)
    # ``rows`` bounds what is broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return cut(with_statistics(texts).select("doc_id", "label", *FEATURES).orderBy("doc_id", *FEATURES), "sample")


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    score = fit(labelled_sample(docs, labels, rows))
    scored = with_statistics(docs.select("doc_id", "text")).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
