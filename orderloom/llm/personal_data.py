"""Personal data by candidate boosting, in DataFrame and SQL functions only.

Generators propose spans, more than are wanted and overlapping ones; a validator of each
kind proves some of them.  Boosted trees (Spark's own) learn from format and context which
candidates a proof tells to be data, a threshold per kind is calibrated on candidates the
trees have not seen, and candidates above it are added to the proven spans of the base
patterns.  There are no labels of personal data in the tables: the proofs are the labels.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text
from orderloom.scratch import stage

KINDS = ("email", "ip", "card", "phone")


@dataclass(frozen=True)
class Generator:
    kind: str
    pattern: str
    needs: str  # texts without a match of this cheap pattern are not searched
    base: bool = False


# Base patterns, written so that a failing start costs one run of its characters: starts
# inside a run are left out by a look behind, unless the match before ended there.  Groups
# that repeat without limit give nothing back: then the matcher needs no stack per round.
GENERATORS = (
    Generator(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        True,
    ),
    Generator("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True),
    Generator("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", True),
    Generator("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True),
    # proposals beside the base
    Generator(
        "email",
        r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,63}"
        r"(?: ?(?:\.|[\[(](?:dot|DOT)[\])]) ?[A-Za-z0-9-]{1,63})++",
        r"[\[(](?:at|AT)[\])]",
    ),
    Generator("ip", r"(?<![0-9])[0-9]{1,3}(?: ?\. ?[0-9]{1,3}){3}(?![0-9])", r"[0-9] ?\. ?[0-9]"),
    Generator("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])", "[0-9]{13}"),
    Generator("card", r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])", "[0-9]{4}[ -][0-9]{4}"),
    Generator(
        "phone",
        r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])",
        r"\+[0-9]",
    ),
    Generator(
        "phone",
        r"(?<![0-9+])(?:\([0-9]{2,4}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
        "[0-9]{3}[ .-][0-9]{4}",
    ),
)

BEFORE, AFTER = 24, 12  # characters of context that a candidate keeps


@dataclass(frozen=True)
class Boosting:
    rounds: int = 10
    depth: int = 4
    precision: float = 0.99  # that the threshold of a kind must reach on unseen candidates
    seed: int = 3


def _candidate(number: int, generator: Generator):
    """What is kept of a match: itself, the length of the gap before it, and context."""
    gap = F.col(f"_gaps{number}")

    def one(match: Column, k: Column) -> Column:
        return F.struct(
            F.lit(number).alias("generator"),
            F.lit(generator.kind).alias("kind"),
            F.lit(generator.base).alias("base"),
            k.alias("k"),
            match.alias("match"),
            F.char_length(F.get(gap, k)).alias("gap"),
            F.right(F.get(gap, k), F.lit(BEFORE)).alias("before"),
            F.left(F.get(gap, k + 1), F.lit(AFTER)).alias("after"),
        )

    return one


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (_row, doc_id, generator, kind, base, start, end, match, before, after).

    Offsets are code points, ends exclusive.  A document without candidates has one row of
    nulls.  Matches of a generator do not overlap, so the lengths of the gaps between them
    give their places: a running sum per document and generator.
    """
    raw = whole_text(text)
    own = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(key).alias("doc_id"), raw.alias("_text")
    )
    found, arrays = own, []
    for number, generator in enumerate(GENERATORS):
        some = F.col("_text").rlike(generator.needs)
        hits = F.regexp_extract_all("_text", F.lit(generator.pattern), F.lit(0))
        gaps = F.split("_text", generator.pattern, -1)
        found = found.withColumn(f"_hits{number}", F.when(some, hits)).withColumn(
            f"_gaps{number}", F.when(some, gaps)
        )
    for number, generator in enumerate(GENERATORS):
        arrays.append(F.transform(f"_hits{number}", _candidate(number, generator)))
    some = F.flatten(F.filter(F.array(*arrays), lambda a: a.isNotNull()))
    rows = found.select("_row", "doc_id", F.explode_outer(some).alias("c"))
    rows = rows.select("_row", "doc_id", "c.*")
    run = Window.partitionBy("_row", "generator").orderBy("k")
    length = F.char_length("match")
    end = F.sum(F.col("gap") + length).over(run)
    return rows.withColumn("end", end).withColumn("start", F.col("end") - length).drop("k", "gap")


def _digits() -> Column:
    return F.regexp_replace("match", "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    """Whether a string of 13 to 19 digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.char_length(digits) + 1 - i, F.lit(1)).cast("int")
        double = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(digit)

    places = F.sequence(F.lit(1), F.char_length(digits))
    total = F.aggregate(places, F.lit(0), add)
    return F.when(F.char_length(digits).between(13, 19), total % 10 == 0).otherwise(False)


def proved(base: bool) -> Column:
    """Whether the match is data of its kind by its form; of a base pattern or proposed."""
    n = F.char_length("_digits")
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    ip = F.col("match").rlike(rf"^{part}(?: ?\. ?{part}){{3}}$")
    phone = n.between(9, 15)
    if not base:
        ip &= ~F.col("match").contains(" ")
        phone &= F.col("match").startswith("+")
    return (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", ip)
        .when(F.col("kind") == "card", F.col("_luhn"))
        .otherwise(phone)
    )


def featured(found: DataFrame) -> DataFrame:
    """Add what the trees see: form of the match and its surroundings."""
    match, before, after = F.col("match"), F.col("before"), F.col("after")
    wide = found.withColumn("_digits", _digits()).withColumn("_luhn", passes_luhn(F.col("_digits")))
    shape = {
        "length": F.char_length(match),
        "n_digits": F.char_length("_digits"),
        "n_dots": F.regexp_count(match, F.lit(r"\.")),
        "n_spaces": F.regexp_count(match, F.lit(" ")),
        "n_dashes": F.regexp_count(match, F.lit("-")),
        "n_groups": F.regexp_count(match, F.lit("[0-9]+")),
        "plus": match.startswith("+"),
        "brackets": match.contains("("),
        "luhn": F.col("_luhn"),
        "byte_parts": match.rlike(r"^(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.|$)"),
        "at": match.contains("@"),
        "top_level": match.rlike(r"\.[A-Za-z]{2,6}$"),
        "different": F.size(F.array_distinct(F.split("_digits", ""))),
        "joined_left": before.rlike("[0-9A-Za-z+.]$"),
        "joined_right": after.rlike("^[0-9A-Za-z]"),
        "number_left": before.rlike("[0-9][ -]?$"),
        "number_right": after.rlike("^[ -]?[0-9]"),
        "named": F.lower(before).rlike("(?:mail|phone|tel|call|fax|card|visa|ip|host|contact)"),
        "assigned": before.rlike("[=:][ \"']*$"),
        **{f"is_{kind}": F.col("kind") == kind for kind in KINDS},
    }
    named = {f"x_{name}": F.coalesce(c.cast("double"), F.lit(0.0)) for name, c in shape.items()}
    return wide.select("*", *[c.alias(name) for name, c in named.items()])


def _features(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("x_")]


def fit(found: DataFrame, boosting: Boosting = Boosting()):
    """Trees and thresholds per kind from all candidates.

    A third of them, by hash, is not shown to the trees; the threshold of a kind is
    the least score from which on at least ``precision`` of those are proved, rising
    scores considered, and 2 (nothing passes) where there is none.  Without candidates of
    both sorts there is no model, and only proved spans are returned.

    Candidates that look the same to the trees are one row with their number as weight, so
    the rounds pass over different forms, of which there are far fewer than candidates.
    """
    columns = _features(found)
    hashed = F.xxhash64("_row", "generator", "start")
    forms = stage(
        found.where("kind is not null")
        .groupBy(
            "kind",
            *columns,
            F.col("proved").cast("double").alias("label"),
            (F.pmod(F.xxhash64(hashed), F.lit(3)) == 0).alias("held"),
        )
        .agg(F.count("*").cast("double").alias("weight")),
        "pii-forms",
    )
    sorts = forms.where("not held").select(F.countDistinct("label")).first()[0]
    if sorts < 2:
        return None, dict.fromkeys(KINDS, 2.0)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    trees = GBTClassifier(
        maxIter=boosting.rounds, maxDepth=boosting.depth, seed=boosting.seed, stepSize=0.3, weightCol="weight"
    ).fit(assembler.transform(forms.where("not held")))
    unseen = score(forms.where("held"), trees)
    # as many rows per kind as there are distinct scores, of which trees have few
    by_score = unseen.groupBy("kind", "score").agg(
        F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")
    )
    down = Window.partitionBy("kind").orderBy(F.col("score").desc())
    reached = by_score.withColumn(
        "precision", F.sum("good").over(down) / F.sum("n").over(down)
    ).where(F.col("precision") >= boosting.precision)
    least = {r[0]: r[1] for r in reached.groupBy("kind").agg(F.min("score")).collect()}
    return trees, {kind: max(0.5, least.get(kind, 2.0)) for kind in KINDS}


def score(df: DataFrame, trees) -> DataFrame:
    assembler = VectorAssembler(inputCols=_features(df), outputCol="features")
    scored = trees.transform(assembler.transform(df))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def find_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", boosting: Boosting = Boosting()
) -> DataFrame:
    """Rows (_row, doc_id, kind, start, end, base); one row of nulls where there is none.

    Base spans are proved matches of the base patterns, leftmost and without overlap per
    kind.  Added ones are proposals that overlap no base span of their kind and score at
    least the kind's threshold.  _row numbers the documents of this result.
    """
    found = stage(candidates(docs, key, text), "pii-candidates")
    judged = featured(found)
    judged = stage(
        judged.withColumn("proved", F.when(F.col("base"), proved(True)).otherwise(proved(False))),
        "pii-features",
    )
    trees, limits = fit(judged, boosting)
    sure = F.col("base") & F.col("proved")
    scored = score(judged, trees) if trees else judged.withColumn("score", F.lit(0.0))
    limit = F.lit(2.0)
    for kind, least in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(least)).otherwise(limit)
    by_kind = Window.partitionBy("_row", "kind").orderBy("start", "end")
    upto = by_kind.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = by_kind.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # base spans in order do not overlap: the last that starts before and the next suffice
    free = (F.coalesce(F.col("_ended"), F.lit(-1)) <= F.col("start")) & (
        F.coalesce(F.col("_starts"), F.lit(1 << 40)) >= F.col("end")
    )
    marked = scored.withColumn(
        "_ended", F.max(F.when(sure, F.col("end"))).over(upto)
    ).withColumn("_starts", F.min(F.when(sure, F.col("start"))).over(after))
    chosen = F.coalesce(
        sure | (~F.col("base") & free & (F.col("score") >= limit)), F.lit(False)
    )
    spans = marked.where(chosen).select("_row", "kind", "start", "end", sure.alias("base"))
    spans = spans.groupBy("_row", "kind", "start", "end").agg(F.max("base").alias("base"))
    rows = found.groupBy("_row").agg(F.first("doc_id").alias("doc_id"))
    return rows.join(spans, "_row", "left")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(F.array(*[F.lit(k) for k in KINDS]), s["no"]), s["start"], s["end"]
            ),
        ),
        ",",
    )


def private_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", boosting: Boosting = Boosting()
) -> DataFrame:
    """Per document the number of base spans of each kind, their digest, and all spans.

    Null texts are empty and have no spans; repeated rows are separate; null ids stay
    null; other columns are not read; empty tables give no rows.
    """
    found = find_spans(docs, key, text, boosting)
    number = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")) - 1
    span = F.when(
        F.col("kind").isNotNull(), F.struct(number.cast("int").alias("no"), "start", "end")
    )
    grouped = found.groupBy("_row").agg(
        F.first("doc_id").alias("doc_id"),
        *[
            F.count(F.when(F.col("base") & (F.col("kind") == kind), 1)).alias(f"n_{kind}")
            for kind in KINDS
        ],
        F.collect_list(F.when(F.col("base"), span)).alias("_base"),
        F.collect_list(span).alias("_all"),
    )
    return grouped.select(
        "doc_id",
        *[f"n_{kind}" for kind in KINDS],
        F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
        _joined(F.col("_all")).alias("spans"),
    )
