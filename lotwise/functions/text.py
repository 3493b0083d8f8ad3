"""Text cleaning, feature names and phrase search as column expressions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..lookups import ACRONYMS, GARBAGE_TEXT

FIELD_MARK = " <FIELD> "
#: Stands between phrases that were found; none holds it.
PHRASE_MARK = "\x1f"


@F.pandas_udf(StringType())
def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: unicodedata.normalize("NFKC", v), na_action="ignore")


def nfkc(c: Column) -> Column:
    """Unicode compatibility form. Values outside ASCII cross to Python in Arrow batches; others cross as nulls."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def clean_text(c: Column) -> Column:
    return F.nullif(squeeze(nfkc(c.cast("string"))), F.lit(""))


def clean_feature_list(c: Column) -> Column:
    """Cleaned, non-empty labels of an array. The array crosses to Python once, joined, not label by label."""
    mark = "␞"
    return F.filter(F.transform(F.split(nfkc(F.array_join(c, mark)), mark), lambda x: squeeze(x)), lambda x: x != "")


def slugify_feature(c: Column, prefix: str = "feat_", max_length: int = 63) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.substring(F.concat(F.lit(prefix), slug), 1, max_length)


def capitalize(word: Column) -> Column:
    """First letter of each part between hyphens in upper case, the rest in lower case."""
    return F.array_join(F.transform(F.split(word, "-"), lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1_000_000)))), "-")


def title_case(c: Column, acronyms: Mapping[str, str] = ACRONYMS) -> Column:
    known = F.create_map(*[F.lit(x) for pair in acronyms.items() for x in pair])

    def word(w: Column) -> Column:
        core = F.regexp_replace(F.lower(w), r"(?U)[^\w-]", "")
        return F.coalesce(F.replace(F.lower(w), core, F.element_at(known, core)), capitalize(w))

    return F.array_join(F.transform(F.split(c, " "), word), " ")


def standardize_text(c: Column, *, garbage: Sequence[str] = GARBAGE_TEXT, acronyms: Mapping[str, str] = ACRONYMS, unicode: bool = True) -> Column:
    """A categorical value in title case, with known acronyms kept; nulls and placeholders are 'Unknown'."""
    value = squeeze(nfkc(c.cast("string")) if unicode else c.cast("string"))
    return F.when(value.isNull() | F.lower(value).isin(*garbage), F.lit("Unknown")).otherwise(title_case(value, acronyms))


def standardize_text_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns that `df` has are standardised; others are skipped."""
    return df.withColumns({c: standardize_text(F.col(c)) for c in columns if c in df.columns})


def standard_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, standard) of the distinct values of the columns, from one pass over them alone."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("pair")
    return df.select(pairs).select("pair.*").distinct().withColumn("standard", standardize_text(F.col("value")))


def with_standard_values(df: DataFrame, columns: Sequence[str], values: DataFrame) -> DataFrame:
    """The columns replaced by their standard form, from a table of `standard_values` that is small enough to be broadcast. Values
    are grouped, which tells the optimizer that each stands once: it leaves out the join of a column that nobody reads."""
    for c in columns:
        known = values.filter(F.col("column") == c).groupBy(F.col("value").alias("_value")).agg(F.first("standard").alias("_standard"))
        standard = F.when(F.col(c).isNull(), standardize_text(F.lit(None), unicode=False)).otherwise(F.col("_standard"))
        df = df.join(F.broadcast(known), df[c] == known["_value"], "left").withColumn(c, standard).drop("_value", "_standard")
    return df


def search_corpus(df: DataFrame, columns: Sequence[str] = ("description", "seller_comments")) -> Column:
    """Lower-case text of the columns that `df` has, with a mark between them that no phrase can span."""
    present = [F.coalesce(F.col(c), F.lit("")) for c in columns if c in df.columns]
    return F.lower(F.concat_ws(FIELD_MARK, *present)) if present else F.lit("")


def phrase_pattern(phrases: Sequence[str]) -> str | None:
    """One alternation of whole phrases, longest first; None where there are none."""
    words = sorted({p.lower().strip() for p in phrases if p.strip()}, key=lambda p: (-len(p), p))
    return r"(?U)\b(?:" + "|".join(re.escape(p) for p in words) + r")\b" if words else None


def keyword_present(corpus: Column, phrases: Sequence[str]) -> Column:
    pattern = phrase_pattern(phrases)
    return F.coalesce(corpus.rlike(pattern), F.lit(False)) if pattern else F.lit(False)


def phrases_found(corpus: Column, phrases: Sequence[str]) -> Column:
    """The longest phrase at each place where one begins, as an array without repeats; one scan for all of them. Phrases may
    overlap: the scan takes in no text, so that each word may begin one."""
    words = sorted({p.lower().strip() for p in phrases if p.strip()}, key=lambda p: (-len(p), p))
    # By first letter, so that most places are passed over after one look.
    by_letter = {}
    for w in words:
        by_letter.setdefault(w[0], []).append(re.escape(w[1:]))
    pattern = "|".join(f"{re.escape(first)}(?:{'|'.join(rest)})" for first, rest in sorted(by_letter.items()))
    return F.array_distinct(F.regexp_extract_all(corpus, F.lit(rf"(?U)\b(?=((?:{pattern})\b))"), F.lit(1)))


def keyword_flags(df: DataFrame, phrases: Mapping[str, Sequence[str]], columns: Sequence[str] = ("description", "seller_comments")) -> DataFrame:
    """A boolean column for each key: whether one of its phrases stands in the corpus as whole words. The corpus is scanned
    once for the phrases of all keys; a key is true if any phrase found is one of its own or begins with one. The phrases found
    are one short text, in which a key's are looked up: a set of an array's entries would be built for each key and row."""
    wanted = {name: {p.lower().strip() for p in words if p.strip()} for name, words in phrases.items()}
    every = set().union(*wanted.values()) if wanted else set()
    if not every:
        return df.withColumns({name: F.lit(False) for name in wanted})
    found = df.withColumn("_corpus", search_corpus(df, columns)).withColumn("_found", F.array_join(phrases_found(F.col("_corpus"), sorted(every)), PHRASE_MARK))
    found = found.withColumn("_found", F.concat(F.lit(PHRASE_MARK), "_found", F.lit(PHRASE_MARK)))
    begins = lambda long, short: re.match(rf"{re.escape(short)}\b", long) is not None

    def flag(words: set[str]) -> Column:
        telling = sorted(p for p in every if any(begins(p, w) for w in words))
        return reduce(lambda a, b: a | b, [F.contains(F.col("_found"), F.lit(PHRASE_MARK + p + PHRASE_MARK)) for p in telling], F.lit(False))

    return found.withColumns({name: flag(words) for name, words in wanted.items()}).drop("_corpus", "_found")
