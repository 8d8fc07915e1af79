"""Quality classifier by a sparse ensemble of rules.

A text is described by statistics, each a Spark column expression: lengths, shares of upper-case
letters, digits, symbols and marks, shares of different words and lines, and so on. A forest of shallow
trees is grown over the statistics of all labelled training rows; every path from a root to a node is a rule, a
conjunction of bounds on statistics. A logistic regression with an L1 penalty weighs the rules and leaves most
of them at zero. What remains is compiled into one column expression, so that scoring is a projection of the
documents: no Python, no shuffle. Trees and weights are fitted by MLlib over the stored statistics of all
labelled rows, without a sample; the driver sees trees and weights only, which are bounded by parameters.

A NULL text is an empty one, whose counts are zero; whole texts are read, of any length. A NULL label
teaches nothing; an id labelled more than once has its smallest label; a label without a document is
ignored; repeated rows teach and score each by itself, so there are no ties to break. With labels of one kind, or
none, every text scores the same smoothed share. An empty table gives an empty one. ``score`` keeps extra
columns; those called score, predicted or n_rules give way."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, crc_of_id, fresh, read, small, stored, word_count

TREES, DEPTH = 16, 3
#: Strength of the L1 penalty, and steps of the fit.
PENALTY, STEPS = 0.001, 60
SEED = 7
#: Weights below this are zero.
LEAST_WEIGHT = 1e-6
#: Labelled rows per partition while trees and weights are fitted.
ROWS_PER_TASK = 20_000
THRESHOLD = 0.3
SYMBOLS = "#*$%&|<>@^~_=+{}[]\\"


def _count(text: Column, pattern: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))


def _counts(text: Column) -> dict[str, Column]:
    words, lines = F.split(text, SPACE), F.split(text, "\n")
    return {"chars": F.char_length(text), "words": word_count(text), "spaces": _count(text, r"[\x20\x09-\x0D]"),
            "symbols": _count(text, f"[{re.escape(SYMBOLS)}]"), "bars": _count(text, r"\|"), "digits": _count(text, "[0-9]"), "marks": _count(text, "[.,;:!?]"),
            "shouts": _count(text, "!"), "upper": _count(text, r"\p{Lu}"), "stops": _count(text, r"[.!?](?=[\x20\x09-\x0D]|\z)"),
            "lines": F.size(lines), "different_lines": F.size(F.array_distinct(lines)), "different_words": F.size(F.array_distinct(words))}


def _statistics(c: dict[str, Column]) -> dict[str, Column]:
    def share(part: Column, whole: Column) -> Column:
        return part.cast("double") / F.greatest(whole, F.lit(1))
    solid = c["chars"] - c["spaces"]
    return {"log_words": F.log1p(c["words"].cast("double")), "word_length": share(solid, c["words"]),
            "symbols_per_word": share(c["symbols"], c["words"]), "bars_per_word": share(c["bars"], c["words"]),
            "digit_share": share(c["digits"], solid), "mark_share": share(c["marks"], solid), "shouts_per_word": share(c["shouts"], c["words"]),
            "upper_share": share(c["upper"], solid), "words_per_stop": share(c["words"], c["stops"]), "words_per_line": share(c["words"], c["lines"]),
            "different_lines": share(c["different_lines"], c["lines"]), "different_words": share(c["different_words"], c["words"])}


#: What a text is described by, in the order of the trees' features.
STATISTICS = ("log_words", "word_length", "symbols_per_word", "bars_per_word", "digit_share", "mark_share", "shouts_per_word", "upper_share",
              "words_per_stop", "words_per_line", "different_lines", "different_words")


def described(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the statistics of ``text``, under names that no column of ``docs`` has, and those names.
    Counts and shares are columns one after the other, so that each count is made once."""
    whole = fresh("_whole", docs.columns)
    out = docs.withColumn(whole, F.coalesce(F.col(text), F.lit("")))
    counts = _counts(F.col(whole))
    counted = {c: fresh(f"_n_{c}", docs.columns) for c in counts}
    out = out.select(*docs.columns, *[e.alias(counted[c]) for c, e in counts.items()])
    names = {s: fresh(f"_{s}", docs.columns) for s in STATISTICS}
    shares = _statistics({c: F.col(n) for c, n in counted.items()})
    return out.select(*docs.columns, *[shares[s].alias(names[s]) for s in STATISTICS]), names


#: A rule: for each statistic that it bounds, above what and up to what.
Rule = dict[str, tuple[float, float]]


def rule_column(rule: Rule, names: dict[str, str] | None = None) -> Column:
    """The condition of ``rule`` on columns called like the statistics (or as ``names`` says)."""
    out: Column | None = None
    for statistic, (above, upto) in sorted(rule.items()):
        value = F.col((names or {}).get(statistic, statistic))
        for bound in ([value > above] if above > -math.inf else []) + ([value <= upto] if upto < math.inf else []):
            out = bound if out is None else out & bound
    return F.lit(True) if out is None else out


_NODE = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def tree_rules(drawing: str) -> list[Rule]:
    """The different rules of a forest, as MLlib draws it: the path to every node but the roots."""
    rules: dict[tuple, Rule] = {}
    path: list[tuple[str, str, float]] = []
    root = 0
    for line in drawing.split("\n"):
        if line.strip().startswith("Tree "):
            path = []
        if not (m := _NODE.match(line)):
            continue
        indent = len(m[1])
        root = indent if not path else root
        path[indent - root:] = [(STATISTICS[int(m[2])], m[3], float(m[4]))]
        rule: Rule = {}
        for statistic, way, bound in path:
            above, upto = rule.get(statistic, (-math.inf, math.inf))
            rule[statistic] = (max(above, bound), upto) if way == ">" else (above, min(upto, bound))
        rules.setdefault(tuple(sorted(rule.items())), rule)
    return list(rules.values())


@dataclass
class RuleEnsemble:
    """Weighted rules; the score of a text is the logistic function of ``base`` and the weights of the
    rules that hold."""

    base: float
    rules: list[tuple[Rule, float]] = field(default_factory=list)

    def columns(self, names: dict[str, str] | None = None) -> tuple[Column, Column]:
        """(score, number of rules that hold) on columns called like the statistics (or as ``names`` says)."""
        total, held = F.lit(float(self.base)), F.lit(0)
        for rule, weight in self.rules:
            holds = rule_column(rule, names).cast("int")
            total, held = total + holds * F.lit(weight), held + holds
        return 1 / (1 + F.exp(-total)), held

    def described(self) -> list[str]:
        """The rules in words, the weightiest first."""
        out = []
        for rule, weight in sorted(self.rules, key=lambda r: -abs(r[1])):
            bounds = [f"{s} > {a:.4g}" for s, (a, _) in sorted(rule.items()) if a > -math.inf] + [f"{s} <= {b:.4g}" for s, (_, b) in sorted(rule.items()) if b < math.inf]
            out.append(f"{weight:+.3f} if " + " and ".join(sorted(bounds)))
        return out


def learn(labelled: DataFrame, label: str = "quality", trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY) -> RuleEnsemble:
    """An ensemble from text and ``label`` (0 or 1) of ``labelled``."""
    known = labelled.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), "text")
    out, names = described(known)
    table = stored(out.select("label", *[F.col(names[s]).alias(s) for s in STATISTICS]), "quality-statistics")
    n, good = table.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not 0 < good < n:
        rate = (good + 0.5) / (n + 1)
        return RuleEnsemble(math.log(rate / (1 - rate)))
    # a few numbers per row: as many partitions as the rows need, dealt in turn, so that copies spread
    rows = stored(table.repartition(-(-n // ROWS_PER_TASK)), "quality-rows")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, bootstrap=False, featureSubsetStrategy="onethird", seed=SEED, labelCol="label",
                                    featuresCol="features").fit(rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features")))
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(math.log(good / (n - good)))
    held = stored(rows.select("label", F.array(*[rule_column(r).cast("double") for r in rules]).alias("held")), "quality-rules")
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=STEPS, labelCol="label", featuresCol="features")
    fitted = lasso.fit(held.select("label", array_to_vector("held").alias("features")))
    weights = fitted.coefficients.toArray().tolist()
    return RuleEnsemble(float(fitted.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > LEAST_WEIGHT])


def score(docs: DataFrame, model: RuleEnsemble, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted (1 if the score reaches ``threshold``) and n_rules (rules that hold)."""
    added = ("score", "predicted", "n_rules")
    kept = [c for c in docs.columns if c.lower() not in added]
    out, names = described(docs)
    value, held = model.columns(names)
    one = fresh("_score", out.columns)
    out = out.select(*kept, value.alias(one), held.alias(added[2]))
    return out.select(*kept, F.col(one).alias("score"), (F.col(one) >= threshold).cast("int").alias("predicted"), "n_rules")


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """text and ``label`` of the training rows: labelled, and crc32 of the id mod 5 is not 0."""
    by_id = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(label).alias(label)).where(F.col(label).isNotNull())
    by_id = by_id.where(crc_of_id(F.col("doc_id")) % 5 != 0)
    return docs.select("doc_id", "text").join(small(by_id, by_id.count()), "doc_id").select("text", label)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = learn(labelled_rows(docs, read(spark, sf_dir, "labels")))
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted", "n_rules")
