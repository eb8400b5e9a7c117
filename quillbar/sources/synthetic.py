"""A synthetic nested catalog with one book per row of a given table, reproducible from the row's id alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillbar.functions.text import drop_quotes, spell_ampersand

# Word lists of our own and the value ranges.
GENRES = ["Adventure", "Biography", "Drama", "Essay", "Poetry", "Science", "Travel"]
FIRST = ["Ada", "Bo", "Cleo", "Dov", "Eira", "Finn", "Gus", "Hana"]
LAST = ["O'Dell", "Park", "Quist", "Rao", "Sole", "Toth"]
WORDS = ["amber", "bridge", "cinder", "delta", "ember", "fjord", "grove", "harbor", "inlet", "juniper"]
SPECIAL = " Très bien, 5 ☆"
MAX_REVIEWERS = 5
MAX_VALUES = 4
DIGEST_MODULUS = 2147483647


def draw(seed: Column, salt: int, bound: int) -> Column:
    """A repeatable number in [0, bound) from a row id and a salt, in exact integer arithmetic."""
    x = F.pmod(seed * 48271 + salt * 69621 + 12345, F.lit(DIGEST_MODULUS))
    return F.pmod(F.floor(F.pmod(x * 16807, F.lit(DIGEST_MODULUS)) / F.lit(1000)), F.lit(bound))


def _pick(words: list[str], n: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), n.cast("int"))


def _counted(n: Column, make) -> Column:
    return F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), make)).otherwise(F.array())


def synthetic_catalog(ids: DataFrame, id_column: str) -> DataFrame:
    """Books with 0-5 reviewers and two arrays of 0-4 values; about one comment in ten has special characters.

    A pure projection: each row depends on its id only, so any split of the input gives the same books.
    """
    i = F.col(id_column).cast("bigint")

    def reviewer(n: Column) -> Column:
        seed = i * 8 + n
        comment = F.concat_ws(" ", *[_pick(WORDS, draw(seed, s, len(WORDS))) for s in (21, 22, 23)], F.lit("& more"))
        marked = F.when(draw(seed, 24, 10) == 0, F.concat(spell_ampersand(comment), F.lit(SPECIAL)))
        return F.struct(
            (draw(seed, 25, 5) + 1).cast("bigint").alias("_stars"),
            drop_quotes(F.concat_ws(" ", _pick(FIRST, draw(seed, 26, len(FIRST))), _pick(LAST, draw(seed, 27, len(LAST))))).alias("name"),
            marked.otherwise(spell_ampersand(comment)).alias("comment"),
        )

    def values(salt: int) -> Column:
        return _counted(draw(i, salt, MAX_VALUES + 1), lambda n: _pick(WORDS, draw(i * 8 + n, salt + 1, len(WORDS))))

    return ids.select(
        F.concat(F.lit("bk"), (i + 101).cast("string")).alias("_id"),
        F.struct(
            F.struct(
                _pick(FIRST, draw(i, 1, len(FIRST))).alias("first"),
                drop_quotes(_pick(LAST, draw(i, 2, len(LAST)))).alias("last"),
            ).alias("name")
        ).alias("author"),
        F.concat_ws(" ", F.initcap(_pick(WORDS, draw(i, 3, len(WORDS)))), _pick(WORDS, draw(i, 4, len(WORDS)))).alias("title"),
        _pick(GENRES, draw(i, 5, len(GENRES))).alias("genre"),
        ((draw(i, 6, 9201) + 799) / 100).alias("price"),
        F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), draw(i, 7, 9000).cast("int")), "yyyy-MM-dd").alias("publish_date"),
        F.struct(_counted(draw(i, 8, MAX_REVIEWERS + 1), reviewer).alias("reviewer")).alias("reviewers"),
        F.struct(values(9).alias("col1")).alias("onemorecolumn"),
        F.struct(values(11).alias("col1")).alias("secondcoloum"),
    )
