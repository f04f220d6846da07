"""Merchants by the longest code that their name begins with.

A ledger writes ``VODACOM DATA 0412 SANDTON`` where the catalogue has the codes
``VODACOM`` and ``VODACOM DATA``.  Every name is taken apart into its prefixes of
whole words, up to as many words as the longest code has; an equi-join finds the
prefixes that are codes, and the longest one is the merchant.  Only different
names are taken apart, and a name has at most as many prefixes as a code has
words, so the join is an ordinary hash join of a few times the names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import upper_trim


def words_of(name: str | Column) -> Column:
    """The words of a standardised name; any run of white space parts them."""
    return F.split(F.trim(F.regexp_replace(upper_trim(name), "\\s+", " ")), " ")


def code_table(codes: DataFrame, code: str = "code", category: str = "category") -> DataFrame:
    """(_code, _words, _category): standardised codes, each once with its smallest category; empty ones don't count."""
    parts = words_of(code)
    rows = codes.select(F.array_join(parts, " ").alias("_code"), F.size(parts).alias("_words"), F.col(category).alias("_category"))
    return rows.filter(F.col("_code") != "").groupBy("_code", "_words").agg(F.min("_category").alias("_category"))


def longest_codes(names: DataFrame, key: str, codes: DataFrame) -> DataFrame:
    """(key, matched_code, matched_category) of the different names in ``names`` that begin with a code."""
    most = codes.agg(F.max("_words")).first()[0] or 0        # one number: the words of the longest code
    parts = words_of(key)
    distinct = names.select(key).filter(F.col(key).isNotNull()).distinct()
    upto = F.least(F.size(parts), F.lit(most))
    prefixes = F.when(upto > 0, F.transform(F.sequence(F.lit(1), upto), lambda n: F.array_join(F.slice(parts, F.lit(1), n), " ")))
    found = distinct.select(key, F.explode(prefixes).alias("_code")).join(codes, "_code")
    best = F.max(F.struct("_words", "_code", "_category")).alias("_b")
    return found.groupBy(key).agg(best).select(key, F.col("_b._code").alias("matched_code"), F.col("_b._category").alias("matched_category"))


def assign_by_code(txn: DataFrame, codes: DataFrame, key: str = "merchant_name") -> DataFrame:
    """Adds matched_code and assigned_category: the category of the longest code, else the transaction's own.

    A NULL name, one that begins with no code, and one whose first word only begins like a code (``BPX`` for
    ``BP``) keep their own category.  A name that makes up a third of the ledger is one row of the join's
    smaller side; the ledger's side of such a name is split by adaptive execution.
    """
    found = longest_codes(txn, key, code_table(codes)).withColumnRenamed(key, "_name")
    joined = txn.join(found, F.col(key) == F.col("_name"), "left")
    return (joined.withColumn("assigned_category", F.coalesce("matched_category", "merchant_category"))
            .drop("_name", "matched_category"))
