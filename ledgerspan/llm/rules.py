"""Quality rules: repetition and size rules, then how far a document's histograms diverge from its language.

Everything is computed inside a document's own row (no word leaves it); only the language references,
sums of about fifty shares per language, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerspan.llm.common import WORD, fresh, let, stored, words_of

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# Guards of the divergence rules: shorter documents, and languages with fewer documents, are not compared.
GUARD_WORDS = 50
GUARD_DOCS = 20
MAX_CLASS_DISTANCE = 0.25
# A text without a common word is 0.30 to 0.33 away from languages in which 17 to 20 of 100 words are common.
MAX_WORD_DISTANCE = 0.29

# Common words of English, German, French and Spanish.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "it", "for", "was",
    "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "ein",
    "de", "la", "le", "et", "les", "des", "un", "du", "que", "est",
    "el", "en", "y", "los", "se", "del", "las", "por", "con", "para",
)
# The character classes; what belongs to none of them is a class of its own.
CLASSES = (r"\x20\x09-\x0D", r"\p{Lu}", r"\p{Nd}", r"""\.,;:!?'"()\-""", r"#*$%&|<>")
LOWER = r"\p{Ll}"
SPACE, SYMBOLS = CLASSES[0], CLASSES[-1]
N_CLASSES = len(CLASSES) + 2  # lower case, those listed, all others


def without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{characters}]+", ""))


def _alike(keys: Column) -> Column:
    """Elements of a sorted array that share everything above the low 31 bits with a neighbour."""
    by = lambda step: lambda x, i: F.shiftright(x.bitwiseXOR(F.get(keys, i + step)), 31) == 0
    none = F.array().cast("array<bigint>")
    # an element may come twice, once for either neighbour
    return let(F.filter(keys, by(1)), lambda f: F.when(F.size(f) == 0, none).otherwise(F.concat(f, F.filter(keys, by(-1)))))


def repeated_words(words: Column, window: int = 3) -> Column:
    """Words covered by windows of `window` words that occur at least twice.

    Windows are hashed; sorting (33 bits of the hash, position) brings equal ones together. What this
    finds is sorted again by the other 31 bits, so two different windows are taken for equal only if
    all 64 bits of both hashes agree. The cost is n log n in the words of the document.
    """
    place = F.lit((1 << 31) - 1).cast("long")

    def counted(w: Column) -> Column:
        hashes = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, window)]))
        return let(F.slice(hashes, F.lit(1), F.greatest(F.size(w) - (window - 1), F.lit(0))), covered)

    def covered(h: Column) -> Column:
        top = lambda x, i: x.bitwiseAND(F.lit(-(1 << 31)).cast("long")).bitwiseOR(i.cast("long"))
        first = F.sort_array(F.transform(h, top))
        low = lambda x: F.shiftleft(F.get(h, x.bitwiseAND(place).cast("int")), 31).bitwiseOR(x.bitwiseAND(place))
        second = let(first, lambda s: let(_alike(s), lambda c: F.sort_array(F.array_distinct(F.transform(c, low)))))
        places = let(second, lambda s: let(_alike(s), lambda c: F.sort_array(F.array_distinct(F.transform(c, lambda x: x.bitwiseAND(place))))))
        return let(places, spread)

    def spread(p: Column) -> Column:
        steps = F.transform(p, lambda x, i: F.least(F.lit(window).cast("long"), F.coalesce(F.get(p, i + 1) - x, F.lit(window).cast("long"))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)

    return let(words, counted)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def character_counts(text: Column) -> Column:
    """Struct of all characters, those of CLASSES, and those left when lower-case letters are taken out.

    Lower case is most of a text, so the other classes are counted in the short rest.
    """
    total = F.length(text)

    def counted(rest: Column) -> Column:
        return F.struct(total.alias("total"), F.length(rest).alias("rest"), F.array(*[without(rest, c) for c in CLASSES]).alias("each"))

    return let(F.regexp_replace(text, f"{LOWER}+", ""), counted)


def class_shares(counts: Column) -> Column:
    total, rest, each = (counts.getField(f).cast(t) for f, t in (("total", "double"), ("rest", "double"), ("each", "array<double>")))
    others = rest - F.aggregate(each, F.lit(0.0), lambda t, x: t + x)
    whole = F.concat(F.array(total - rest), each, F.array(others))
    return F.transform(whole, lambda x: F.when(total > 0, x / total).otherwise(0.0))


def common_word_shares(words: Column) -> Column:
    """Shares of the common words and, last, of all other words."""
    total = F.size(words).cast("double")
    kept = F.filter(F.transform(words, F.lower), lambda x: x.isin(*COMMON_WORDS))

    def counted(s: Column) -> Column:
        each = [(F.length(s) - F.length(F.replace(s, F.lit(f" {w} "), F.lit("")))) / F.lit(float(len(w) + 2)) for w in COMMON_WORDS]
        return let(F.array(*each), shares)

    def shares(found: Column) -> Column:
        rest = total - F.aggregate(found, F.lit(0.0), lambda t, x: t + x)
        return F.transform(F.concat(found, F.array(rest)), lambda x: F.when(total > 0, x / total).otherwise(0.0))

    # two blanks between words, so that no two occurrences share one
    return let(F.concat(F.lit(" "), F.array_join(kept, "  "), F.lit(" ")), counted)


def profile(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """Add a struct column `name` with the counts of the base rules and both histograms."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def per_word(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"), common_word_shares(w).alias("words"))

    def per_character(c: Column) -> Column:
        each = c.getField("each")
        return F.struct(
            (c.getField("total") - F.get(each, F.lit(0))).cast("long").alias("word_chars"),
            F.get(each, F.lit(len(CLASSES) - 1)).cast("long").alias("n_symbols"),
            class_shares(c).alias("classes"),
        )

    w, c, lines = (fresh(docs.columns, f"{name}_{x}") for x in ("w", "c", "d"))
    split = docs.withColumns({w: let(words_of(whole), per_word), c: let(character_counts(whole), per_character), lines: duplicate_lines(whole)})
    fields = [F.col(f"`{w}`.{f}") for f in ("n_words", "n_repeat_words", "words")] + [F.col(f"`{c}`.{f}") for f in ("word_chars", "n_symbols", "classes")]
    return split.withColumn(name, F.struct(*fields, F.col(lines).alias("n_dup_lines"))).drop(w, c, lines)


def base_failed(p: str) -> Column:
    n, repeated = F.col(f"`{p}`.n_words"), F.col(f"`{p}`.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def references(profiled: DataFrame, p: str, lang: str = "lang") -> DataFrame:
    """Mean histograms per language over all documents that pass the base rules; null is a language too."""
    good = profiled.where(~base_failed(p))
    means = [
        F.array(*[F.avg(F.get(F.col(f"`{p}`.{part}"), F.lit(i))) for i in range(n)]).alias(part)
        for part, n in (("classes", N_CLASSES), ("words", len(COMMON_WORDS) + 1))
    ]
    return good.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n_docs"), *means)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two share arrays."""
    def side(x: Column, y: Column) -> Column:
        parts = F.zip_with(x, y, lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0))
        return F.aggregate(parts, F.lit(0.0), lambda t, v: t + v)

    return F.sqrt(F.greatest(F.lit(0.0), (side(p, q) + side(q, p)) / 2))


def judge(profiled: DataFrame, p: str, name: str, lang: str = "lang") -> DataFrame:
    """Add a struct column `name`: base_failed, class_distance, word_distance, kept.

    Distances are null where a guard applies; then the base rules alone decide.
    """
    seen = stored(references(profiled, p, lang), "language-references")
    key, ref = fresh(profiled.columns, "__lang"), fresh(profiled.columns, "__reference")
    known = seen.where(F.col("n_docs") >= GUARD_DOCS).select(F.col("lang").alias(key), F.struct("classes", "words").alias(ref))
    joined = profiled.join(known, profiled[lang].eqNullSafe(F.col(key)), "left")
    compared = (F.col(f"`{p}`.n_words") >= GUARD_WORDS) & F.col(f"`{ref}`").isNotNull()
    distance = {
        part: F.when(compared, divergence(F.col(f"`{p}`.{part}"), F.col(f"`{ref}`.{part}"))) for part in ("classes", "words")
    }
    pair = fresh(joined.columns, "__distance")
    joined = joined.withColumn(pair, F.struct(distance["classes"].alias("c"), distance["words"].alias("w")))
    failed = base_failed(p)
    far = (F.col(f"{pair}.c") > MAX_CLASS_DISTANCE) | (F.col(f"{pair}.w") > MAX_WORD_DISTANCE)
    verdict = F.struct(
        failed.alias("base_failed"),
        F.col(f"{pair}.c").alias("class_distance"),
        F.col(f"{pair}.w").alias("word_distance"),
        (~failed & ~F.coalesce(far, F.lit(False))).alias("kept"),
    )
    return joined.withColumn(name, verdict).drop(key, ref, pair)


def report(docs: DataFrame) -> DataFrame:
    """One row per document with the counts of the base rules and the verdict, without its text.

    Null and empty texts have no words and fail; repeated rows are judged alike; an empty table gives none.
    """
    thin = stored(profile(docs.select("doc_id", "lang", "text"), "p").drop("text"), "quality-profiles")
    judged = judge(thin, "p", "v")
    counts = [F.col(f"p.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return judged.select("doc_id", *counts, "v.base_failed", "v.kept", "v.class_distance", "v.word_distance")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns of `docs`."""
    p, v = fresh(docs.columns, "__profile"), fresh(docs.columns, "__verdict")
    judged = judge(stored(profile(docs, p), "quality-docs"), p, v)
    return judged.where(f"`{v}`.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
