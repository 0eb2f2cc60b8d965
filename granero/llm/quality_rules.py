"""Quality rules over free text: base counts, then divergence from language references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.common import put_aside

# Very common words of the four languages met in the texts.
COMMON_WORDS: dict[str, tuple[str, ...]] = {
    "en": ("the", "of", "and", "a", "to", "in", "is", "you", "that", "it", "he", "was", "for", "on", "are", "as", "with"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "no", "una", "para"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "par", "sur"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "für", "ist", "im", "dem",
           "ein"),
}
# Shares (of 10,000) of the character classes and of the common words (sorted), means over the records of
# sf0.1 labelled as good. No source can move them, and a language unknown here has none.
CLASS_REFERENCES: dict[str, tuple[int, ...]] = {
    "en": (7939, 144, 0, 10, 1663, 0, 244),
    "es": (7994, 143, 0, 9, 1616, 0, 237),
    "fr": (7928, 146, 0, 19, 1662, 0, 245),
    "de": (8094, 132, 0, 8, 1545, 0, 221),
}
WORD_REFERENCES: dict[str, tuple[int, ...]] = {
    "en": (624, 1073, 203, 243, 0, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 126, 0, 0, 354, 0, 124, 0, 538, 477, 0,
           369, 1, 0, 0, 0, 0, 1, 0, 1298, 298, 0, 0, 0, 0, 0, 0, 0, 0, 0, 403, 2519, 779, 0, 0, 0, 0, 0, 312, 255,
           0, 0, 0),
    "es": (1, 1, 1, 141, 0, 260, 0, 0, 2492, 319, 0, 1, 3, 1, 0, 1, 0, 723, 650, 0, 0, 4, 0, 2, 0, 0, 3, 1, 3,
           1268, 418, 0, 0, 452, 3, 225, 4, 1, 1, 208, 311, 1, 1024, 0, 395, 0, 0, 3, 15, 4, 311, 230, 3, 0, 1, 0,
           2, 513, 0, 1),
    "fr": (2, 3, 0, 0, 0, 0, 229, 0, 2422, 0, 0, 0, 0, 536, 0, 359, 0, 0, 515, 261, 740, 1, 0, 0, 0, 3, 1, 0, 2,
           1320, 1, 981, 595, 0, 0, 0, 3, 101, 196, 0, 0, 281, 287, 227, 0, 0, 189, 0, 8, 1, 428, 0, 0, 307, 0, 1,
           0, 1, 0, 0),
    "de": (1, 2, 1, 0, 291, 0, 0, 423, 2, 0, 203, 637, 2415, 292, 1267, 0, 204, 0, 153, 0, 0, 0, 257, 0, 229, 736,
           2, 223, 0, 0, 0, 0, 0, 0, 344, 0, 3, 0, 0, 0, 0, 0, 0, 0, 0, 335, 0, 0, 8, 2, 0, 0, 1015, 0, 512, 1, 0,
           0, 0, 439),
}
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "symbol", "other")
WHITE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
MAX_LANGUAGES = 1000  # bound of the reference table that the driver holds


def _length_kept(text: Column, dropped: str) -> Column:
    return F.length(F.regexp_replace(text, dropped, ""))


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _with_repeat_words(rows: DataFrame) -> DataFrame:
    """Adds `n_repeat_words`: words of `_words` inside 3-word windows that occur twice or more there.

    A window is one whole number: its hash, shifted left to make room for its place. Sorted, equal windows are
    neighbours; the marked places, sorted again, cover three words each, less what the next one covers again.
    """
    windows = F.greatest(F.size("_words") - 2, F.lit(0))
    rows = rows.withColumn("_bits", F.ceil(F.log2(F.greatest(windows, F.lit(2)))).cast("int"))
    rows = rows.withColumn("_codes", F.sort_array(F.transform(F.slice("_words", 1, windows), lambda w, i: F.call_function(
        "shiftleft", F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)), F.col("_bits")).bitwiseOR(i.cast("long")))))

    def window_of(code: Column) -> Column:
        return F.call_function("shiftright", code, F.col("_bits"))

    marked = F.filter("_codes", lambda c, i: (window_of(c) == window_of(F.get("_codes", i + 1)))
                      | (window_of(c) == window_of(F.get("_codes", i - 1))))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bits")) - 1
    rows = rows.withColumn("_places", F.sort_array(F.transform(marked, lambda c: c.bitwiseAND(mask))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))

    def cover(acc: Column, at: Column) -> Column:
        return F.struct((acc["n"] + at + 3 - F.greatest(acc["upto"], at)).alias("n"), (at + 3).alias("upto"))

    return rows.withColumn("n_repeat_words", F.aggregate("_places", start, cover, lambda acc: acc["n"]))


def text_features(records: DataFrame, key: str, text: str, language: str) -> DataFrame:
    """One row per record: base counts and both histograms. A map-only step over built-in functions."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    base = records.select(F.col(key).alias("_key"), F.col(language).cast("string").alias("_language"), body.alias("_t"))
    words = F.array_remove(F.split("_t", WHITE), "")
    base = base.withColumn("_words", words)
    lines = F.filter(F.split("_t", "\n"), lambda line: F.rlike(line, F.lit("[^\\x20\\x09-\\x0D]")))
    common = sorted({w for group in COMMON_WORDS.values() for w in group})
    found = F.concat(F.lit(" "), F.array_join(F.filter(F.split(F.lower("_t"), WHITE), lambda w: w.isin(common)), "  "),
                     F.lit(" "))
    base = _with_repeat_words(base.withColumn("_lines", lines).withColumn("_found", found))
    word_chars = _length_kept(F.col("_t"), WHITE)
    n_symbols = F.length("_t") - _without(F.col("_t"), SYMBOLS)
    counts = base.select(
        "_key", "_language", F.size("_words").cast("long").alias("n_words"), word_chars.cast("long").alias("word_chars"),
        n_symbols.cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.length("_t").cast("long").alias("_chars"),
        _length_kept(F.col("_t"), "\\P{Ll}+").cast("long").alias("_lower"),
        _length_kept(F.col("_t"), "\\P{Lu}+").cast("long").alias("_upper"),
        _length_kept(F.col("_t"), "[^\\p{Lt}\\p{Lm}\\p{Lo}]+").cast("long").alias("_other_letter"),
        _length_kept(F.col("_t"), "\\P{Nd}+").cast("long").alias("_digit"), "_found")
    space = F.col("_chars") - F.col("word_chars")
    other = F.greatest(F.lit(0), F.col("word_chars") - F.col("_lower") - F.col("_upper") - F.col("_other_letter")
                       - F.col("_digit") - F.col("n_symbols"))
    tally = [((F.octet_length("_found") - F.octet_length(F.replace("_found", F.lit(f" {w} "), F.lit(""))))
              / len(f" {w} ".encode())).cast("long") for w in common]
    return counts.select(
        "_key", "_language", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.array("_lower", "_upper", "_other_letter", "_digit", space, F.col("n_symbols"), other).alias("_classes"),
        F.array(*tally).alias("_common"))


def _total(histogram: str) -> Column:
    return F.aggregate(histogram, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_shares(rows: DataFrame, histogram: str) -> DataFrame:
    """Adds the histogram's total and its shares (0 where the total is 0)."""
    rows = rows.withColumn(f"{histogram}_total", _total(histogram))
    divisor = F.greatest(F.col(f"{histogram}_total"), F.lit(1)).cast("double")
    return rows.withColumn(f"{histogram}_divisor", divisor).withColumn(
        f"{histogram}_share", F.transform(histogram, lambda x: x / F.col(f"{histogram}_divisor")))


def jensen_shannon(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms given as shares."""
    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    parts = F.zip_with(p, q, lambda x, y: part(x, y) + part(y, x))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2))


def _references(features: DataFrame) -> tuple[list[list[float]], list[list[float]]]:
    """Shares per language over all records that pass the base rules; one small row per language."""
    sums = [F.sum(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, n in (("_classes", len(CLASSES)), ("_common", _n_common()))
            for i in range(n)]
    rows = features.filter(~_base_failed()).groupBy("_language").agg(*sums).orderBy("_language").limit(MAX_LANGUAGES + 1)
    found = rows.collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def shares(row, name: str, n: int) -> list[float]:
        values = [float(row[f"{name}{i}"] or 0) for i in range(n)]
        total = sum(values)
        return [v / total for v in values] if total else []

    classes = [shares(r, "_classes", len(CLASSES)) for r in found]
    common = [shares(r, "_common", _n_common()) for r in found]
    return [x for x in classes if x], [x for x in common if x]


def _fixed(references: Mapping[str, Sequence[int]]) -> list[list[float]]:
    """Shares of the fixed references, by language."""
    return [[v / sum(r) for v in r] for r in references.values()]


def _settled(rows: DataFrame) -> DataFrame:
    """The rows as they are; no later expression is merged into theirs, so each column is computed once."""
    return rows.select(F.explode(F.array(F.struct("*"))).alias("_settled")).select("_settled.*")


def _n_common() -> int:
    return len({w for group in COMMON_WORDS.values() for w in group})


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _nearest(shares: str, references: Sequence[Sequence[float]]) -> Column:
    """Distance to the nearest reference."""
    if not references:
        return F.lit(0.0)
    each = [jensen_shannon(F.col(shares), F.array(*[F.lit(float(v)) for v in r])) for r in references]
    return F.least(*each, each[0])


def quality_verdicts(records: DataFrame, key: str = "ln_folio_incidencia", text: str = "descripcion",
                     language: str = "idioma", *, max_class_distance: float = 0.3, max_word_distance: float = 0.8,
                     min_chars: int = 200, min_common: int = 20, fixed_references: bool = False) -> DataFrame:
    """Verdict on each incident's `descripcion`: base rules, then divergence from the languages' own histograms.

    References are the character-class and common-word histograms of each language, summed over all records that pass
    the base rules, as the query's SQL has it; with `fixed_references` they are `CLASS_REFERENCES` and `WORD_REFERENCES`,
    which a large source of junk in the table cannot draw to itself. A record is rejected when its Jensen-Shannon distance to the nearest language is above
    `max_class_distance` for character classes or `max_word_distance` for common words. Guards: the first test needs
    `min_chars` characters, the second `min_common` common words; below them it passes.

    Nulls: a null text counts as empty (no words, base rules fail); null keys and languages are kept, a null language is
    one more reference group (fixed references take no notice of it). Repeated rows give repeated rows; other columns are ignored; an empty table gives no rows.
    """
    features = text_features(records, key, text, language)
    if fixed_references:
        features = _settled(features)
        classes, common = _fixed(CLASS_REFERENCES), _fixed(WORD_REFERENCES)
    else:
        features = put_aside(features, "quality")  # read twice: for the references and for the verdicts
        classes, common = _references(features)
    scored = _with_shares(_with_shares(features, "_classes"), "_common").withColumn(
        "class_distance", F.when(F.col("_classes_total") >= min_chars, _nearest("_classes_share", classes))).withColumn(
        "word_distance", F.when(F.col("_common_total") >= min_common, _nearest("_common_share", common)))
    scored = scored.withColumn("base_failed", _base_failed())
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    return scored.select(F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance")


def keep_good(records: DataFrame, text: str = "descripcion", language: str = "idioma") -> DataFrame:
    """The records that `quality_verdicts` keeps by the fixed references, all columns as they came, in one map-only step."""
    rows = records.select(F.struct("*").alias("_row"), F.col(text).alias("_body"), F.col(language).alias("_lang"))
    return quality_verdicts(rows, "_row", "_body", "_lang", fixed_references=True).filter("kept").select("_row.*")
