"""Secret scans: candidates by shape, then a random forest that removes false positives.

A candidate is a whole run of 16 or more characters of keys, with a digit in it, or any value that is
assigned to a telling name, whatever its length and characters. The forest looks at its length and
character transitions, how much of it a dictionary covers, and whether a path or telling words stand
beside it. It is trained from labelled findings; candidates, features and scoring are column expressions
and the forest that of Spark ML, so nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerspan.llm.common import crc_remainder, fresh, stored

RUN = r"[A-Za-z0-9+/_\-]"
LONG = rf"(?<!{RUN})(?=[A-Za-z+/_\-]*[0-9]){RUN}{{16,}}+"
BEFORE, AFTER = 32, 8  # characters of context
TREES, DEPTH, SEED = 30, 6, 5
THRESHOLD = 0.5
DIVISOR, HELD_OUT = 5, 0

# Names that secrets are assigned to, formats that issuers document, and frequent parts of words.
NAMES = r"(?i:pass(?:word|wd|phrase)?|pwd|secret|token|api[_\-]?key|access[_\-]?key|private[_\-]?key|auth|bearer|credential)"
TELLING = rf"(?:{NAMES}|(?i:key))"  # wider, for candidates
SCHEME = r"(?:(?i:bearer|basic|token)\s{1,8})?"
GIVEN = rf"[\"']?\s{{0,8}}(?:=>|:=|=|:)\s{{0,8}}{SCHEME}[\"']?"
ASSIGNED = rf"{NAMES}{RUN}*+{GIVEN}$"
# A run is taken at once, after one look at whether it holds a name, so that no place of a long one is tried again.
PREFIX = rf"(?:(?<!{RUN})(?={RUN}*?{TELLING}){RUN}++{GIVEN}{SCHEME}|(?<!{RUN})(?i:bearer)\s{{1,8}})"
# Inside quotes up to the closing one, with blanks unless that would hide a long run; else up to a blank, a quote or the next parameter of an address.
QUOTED = "|".join(rf"(?<={q})(?:[^{q}\s]++(?={q})|(?![^{q}\r\n]*{RUN}{{16}})[^{q}\r\n]++(?={q}))" for q in ("\"", "'"))
VALUE = rf"(?:{QUOTED}|(?:[^\s\"'&]++|&(?![\w.\-]+=))++)"
CLOSING = ",;)]}>"  # marks at the end of a value that aren't of it
CANDIDATE = rf"(?:{PREFIX}{VALUE}|{LONG})"
FORMATS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^sk[-_][A-Za-z0-9_\-]{20,}$|^xox[abprs]-[A-Za-z0-9\-]{10,}$"
PARTS = r"(?i)(tion|ing|the|and|ent|ion|for|ere|her|ter|hat|tha|ate|all|eth|ver|his|oft|ith|com|www|http|file|data|user|home|index|image|page|test)"
FEATURES = (
    "length", "transitions", "digit_share", "upper_share", "hex", "digits_only", "distinct_share", "dictionary", "slashes", "separators",
    "path_beside", "assigned", "name_beside", "quoted", "format",
)
# What rule_labels decides by would be all that a forest learns from its labels.
BY_RULE = ("digits_only", "assigned", "format")
LEARNED = tuple(f for f in FEATURES if f not in BY_RULE)


def candidates(docs: DataFrame, row: str | None = None) -> DataFrame:
    """(row, doc_id, number, start, candidate, named, before, after): every candidate with its place in the text.

    `row` numbers the documents (by the column of that name, if given), `start` counts characters from 0, and
    `named` is the name that the candidate is assigned to, with what stands between them, or empty.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    number = F.col(row) if row else F.monotonically_increasing_id()
    found = docs.select(number.alias("row"), "doc_id", text.alias("t"), F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0)).alias("found"))
    # n candidates cut the text into n + 1 pieces
    cut = found.where(F.size("found") > 0).withColumn("pieces", F.split("t", CANDIDATE, -1))
    each = cut.select("row", "doc_id", "pieces", F.posexplode("found").alias("number", "match"))
    value = F.regexp_replace("match", f"^{PREFIX}(?=.)", "")
    named = F.left("match", F.length("match") - F.length("value"))
    piece, following = F.get("pieces", F.col("number")), F.get("pieces", F.col("number") + 1)
    # closing marks stay with a value up to its quote and before the next parameter
    inside = following.startswith("&") | (F.right("named", F.lit(1)).isin('"', "'") & following.startswith(F.right("named", F.lit(1))))
    closed = F.rtrim("value", F.lit(CLOSING))
    candidate = F.when(F.coalesce(inside, F.lit(False)), F.col("value")).when(closed == "", F.left("value", F.lit(1))).otherwise(closed)
    placed = each.withColumn("value", value).withColumn("named", named).withColumn("candidate", candidate)
    tail = F.right("value", F.length("value") - F.length("candidate"))
    placed = placed.select(
        "row", "doc_id", "number", "candidate", "named", F.length(piece).alias("gap"), F.length("match").alias("taken"), F.length(tail).alias("tail"),
        F.right(F.concat(piece, "named"), F.lit(BEFORE)).alias("before"), F.left(F.concat(F.left(tail, F.lit(AFTER)), following), F.lit(AFTER)).alias("after"),
    )
    by_place = Window.partitionBy("row").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("taken")).over(by_place)
    return placed.withColumn("start", (end - F.col("tail") - F.length("candidate")).cast("long")).drop("gap", "taken", "tail")


def _share(c: Column, characters: str) -> Column:
    return 1 - F.length(F.regexp_replace(c, f"[{characters}]", "")) / F.length(c)


def described(found: DataFrame) -> DataFrame:
    """Add the features."""
    c, before, after = F.col("candidate"), F.col("before"), F.col("after")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0")
    flag = lambda x: x.cast("double")
    values = {
        "length": flag(F.length(c)),
        "transitions": (F.length(kinds) - 1) / F.length(c),
        "digit_share": _share(c, "0-9"),
        "upper_share": _share(c, "A-Z"),
        "hex": flag(c.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "digits_only": flag(c.rlike("^[0-9]+$")),
        "distinct_share": F.size(F.array_distinct(F.split(c, ""))) / F.length(c),
        "dictionary": 1 - F.length(F.regexp_replace(c, PARTS, "")) / F.length(c),
        "slashes": _share(c, "/"),
        "separators": _share(c, r"_\-+"),
        "path_beside": flag(before.rlike(r"([/\\.~@]|://[^\s]*)$") | after.rlike(r"^[./\\@]\w")),
        "assigned": flag(F.col("named").rlike(ASSIGNED)),
        "name_beside": flag(F.col("named").rlike(NAMES) | before.rlike(NAMES)),
        "quoted": flag(before.rlike("[\"']$") & after.rlike("^[\"']")),
        "format": flag(c.rlike(FORMATS)),
    }
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in values.items()})


def rule_labels(found: DataFrame) -> DataFrame:
    """Labelled findings where nobody has labelled any, of what is sure alone; the forest decides on all others.

    1 for a documented format, or letters with digits or marks that are assigned to a telling name and hold few
    parts of words; 0 for plain numbers and dictionary words or paths that aren't assigned, and for words that
    are. Only candidates that are not held out get a label.
    """
    c = F.col("candidate")
    mixed = c.rlike("[A-Za-z]") & c.rlike("[^A-Za-z\\s]") & (F.length(c) >= 8)
    secret = (F.col("format") == 1) | ((F.col("assigned") == 1) & mixed & (F.col("dictionary") < 0.3) & (F.col("slashes") == 0) & ~c.rlike("\\s"))
    word = c.rlike("^\\p{L}+[.,;:!?]?$") & ((F.col("dictionary") >= 0.3) | (F.length(c) < 8))
    plain = (F.col("assigned") == 0) & ((F.col("digits_only") == 1) | (F.col("dictionary") >= 0.3) | ((F.col("slashes") > 0) & (F.col("path_beside") == 1)))
    label = F.when(secret, 1.0).when(word | plain, 0.0)
    return found.where(crc_remainder(F.col("doc_id"), DIVISOR) != HELD_OUT).withColumn("label", label).where("label is not null")


def without_names(labelled: DataFrame) -> DataFrame:
    """`labelled`, and its secrets once more as they would stand without name and quotes: rules find them by these."""
    return labelled.unionByName(labelled.where("label = 1").withColumns({"name_beside": F.lit(0.0), "quoted": F.lit(0.0)}))


def train(labelled: DataFrame, features: tuple[str, ...] = FEATURES):
    """The forest from labelled findings (features and `label`), or None without findings of both kinds."""
    if labelled.select("label").distinct().count() < 2:
        return None
    data = stored(VectorAssembler(inputCols=list(features), outputCol="features").transform(labelled.select("label", *features)).select("label", "features"), "secret-labels")
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(data)


def judged(found: DataFrame, model, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Add `score` and `is_secret`; without a model every candidate counts as a secret."""
    if model is None:
        return found.withColumns({"score": F.lit(1.0), "is_secret": F.lit(True)})
    scored = model.transform(VectorAssembler(inputCols=list(features), outputCol="features").transform(found))
    score = F.get(vector_to_array("probability"), F.lit(1))
    return scored.withColumn("score", score).withColumn("is_secret", F.col("score") >= THRESHOLD).drop("features", "rawPrediction", "probability", "prediction")


def judged_by_rules(found: DataFrame) -> DataFrame:
    return judged(found, train(without_names(rule_labels(found)), LEARNED), LEARNED)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, start, length, score, is_secret and the candidate itself, one row per candidate.

    `labelled` are findings with features and label; by default those of `rule_labels`. Null and empty
    texts have no candidates; repeated rows have theirs each; an empty table gives none.
    """
    found = stored(described(candidates(docs)), "secret-candidates")
    scored = judged_by_rules(found) if labelled is None else judged(found, train(labelled))
    return scored.select("doc_id", "start", F.length("candidate").alias("length"), "score", "is_secret", "candidate")


def masked(docs: DataFrame) -> DataFrame:
    """`docs` with every secret replaced by as many asterisks, one of 16 characters or more wherever it stands; other columns stay."""
    number, at, found_name = (fresh(docs.columns, x) for x in ("__row", "__at", "__secrets"))
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "secret-docs")
    found = stored(described(candidates(numbered, number)), "secret-candidates")
    bad = judged_by_rules(found).where("is_secret")
    per_text = stored(bad.groupBy(F.col("row").alias(at)).agg(F.collect_set(F.struct("start", "candidate")).alias(found_name)), "secret-texts")
    met = numbered.join(per_text, F.col(number) == F.col(at), "left")
    secrets = F.coalesce(F.col(found_name), F.array().cast("array<struct<start:bigint,candidate:string>>"))

    def hidden(t: Column, x: Column) -> Column:
        start, value = x.getField("start").cast("int"), x.getField("candidate")
        stars = F.repeat(F.lit("*"), F.length(value))
        there = F.overlay(t, stars, start + 1, F.length(value))
        return F.when(F.length(value) >= 16, F.replace(there, value, stars)).otherwise(there)

    cleaned = F.aggregate(secrets, F.col("text"), hidden)
    return met.select(*[cleaned.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
