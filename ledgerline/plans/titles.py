"""Contract and form categories of document and template titles.

Nouns are found by dictionary: the longest dictionary noun at each place, left
to right. The first one with a category decides.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.operators.matching import not_in
from ledgerline.sources.tables import append_new

# Category of a title without a known noun ("other").
OTHER = "기타"

DOCUMENT = ["documentid", "userid", "workspaceid", "estimated_workspaceid", "createdat"]
TEMPLATE = ["templateid", "workspaceid", "memberid", "title", "createdat"]


def new_documents(document: DataFrame, service: DataFrame, test_user: DataFrame, done: DataFrame) -> DataFrame:
    """Documents of real users not classified yet, with the title from ``service``."""
    fresh = append_new(document.withColumnRenamed("id", "documentid"), done, "documentid")
    real = fresh.join(test_user.select("userid"), "userid", "left_anti")
    titles = service.select(F.col("id").alias("documentid"), "title")
    return real.join(titles, "documentid", "left").select(*DOCUMENT[:3], "title", *DOCUMENT[3:])


def new_templates(template: DataFrame, test_workspaces: DataFrame, done: DataFrame | None) -> DataFrame:
    """Templates outside test workspaces; with ``done``, only those not classified yet.

    Pass no ``done`` when the result replaces the table, else old rows are lost.
    """
    rows = not_in(template.withColumnRenamed("id", "templateid"), "workspaceid", test_workspaces)
    if done is not None:
        rows = append_new(rows, done, "templateid")
    return rows.select(*TEMPLATE)


def noun_dictionary(nouns: DataFrame, **categories: DataFrame) -> DataFrame:
    """One row per listed noun, with its category from each map (NULL if none).

    Each map has columns noun and category, as ``load_category_map`` gives them
    under the same name.
    """
    words = nouns.where(F.col("noun").isNotNull() & (F.col("noun") != "")).select("noun").distinct()
    for name, pairs in categories.items():
        words = words.join(pairs.groupBy("noun").agg(F.max(name).alias(name)), "noun", "left")
    return words


def clean_title(title: Column) -> Column:
    """Trimmed title; a missing one is empty."""
    return F.coalesce(F.regexp_replace(title, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), F.lit(""))


def noun_pattern(nouns: list[str], whole_words: bool = False) -> str:
    longest_first = sorted(set(nouns), key=lambda noun: (-len(noun), noun))
    either = "|".join(re.escape(noun) for noun in longest_first)
    return rf"\b({either})\b" if whole_words else f"({either})"


def title_nouns(title: Column, nouns: list[str], whole_words: bool = False) -> Column:
    """All dictionary nouns of the whole title, in order of appearance."""
    if not nouns:
        return F.array().cast("array<string>")
    pattern = noun_pattern(nouns, whole_words)
    return F.regexp_extract_all(clean_title(title), F.lit(pattern), F.lit(1))


def classify(
    titles: DataFrame,
    dictionary: DataFrame,
    categories: list[str],
    key: str,
    whole_words: bool = False,
) -> DataFrame:
    """Add ``nouns`` and one column per category of the first categorised noun.

    ``dictionary`` has one row per noun (see ``noun_dictionary``); of repeated
    nouns the one with the largest categories counts. At each place of a title
    the beginning that all nouns are long enough for is looked up, and only
    where some noun begins like that, the lengths of such nouns; the longest
    noun at the first place is taken, then the search goes on behind it. With
    ``whole_words`` a noun must not touch letters or digits that continue it.
    Only hits carry on, by key and place, never the title, and the hits of a
    title are settled in one aggregate.
    """
    titles = titles.where(F.col(key).isNotNull() & (F.col(key) != ""))
    merged = [F.max(c).alias(c) for c in categories]
    nouns = dictionary.where(F.length("noun") > 0).groupBy("noun").agg(*merged)
    least = nouns.agg(F.min(F.length("noun"))).scalar()
    heads = nouns.withColumn("head", F.substring("noun", F.lit(1), least)).groupBy("head")
    heads = heads.agg(F.collect_set(F.length("noun")).alias("lengths"))
    text = clean_title(F.col("title"))
    one = [key, "_text"]  # the key, and a hash of the title in case a key has several
    named = titles.withColumn("_text", F.xxhash64(text))
    places = (
        named.select(*one, text.alias("t"), least.alias("least"))
        .where(F.length("t") >= F.col("least"))
        .select(*one, "t", "least", F.explode(F.sequence(F.lit(1), F.length("t") - F.col("least") + 1)).alias("at"))
        .withColumn("head", F.expr("substring(t, at, least)"))
    )
    pieces = (
        places.join(heads, "head")
        .select(*one, "t", "at", F.explode("lengths").alias("n"))
        .where(F.col("at") + F.col("n") - 1 <= F.length("t"))
    )
    if whole_words:
        word = r"[\p{L}\p{N}_]{2}"
        before = F.expr("if(at = 1, '', substring(t, at - 1, 2))")
        after = F.expr("substring(t, at + n - 1, 2)")
        pieces = pieces.where(~before.rlike(word) & ~after.rlike(word))
    hits = pieces.select(*one, "at", "n", F.expr("substring(t, at, n)").alias("noun")).join(nouns, "noun")
    each = F.struct("at", (-F.col("n")).alias("less"), "noun", *categories)
    per_title = hits.groupBy(*one).agg(F.array_sort(F.collect_list(each)).alias("hits")).withColumn("kept", _first_come("hits"))
    decided = F.filter("kept", lambda hit: hit[categories[0]].isNotNull())
    per_title = per_title.select(*one, F.col("kept.noun").alias("nouns"), F.get(decided, F.lit(0)).alias("_hit"))
    found = named.join(per_title, one, "left")
    return found.select(
        *titles.columns,
        F.coalesce("nouns", F.array().cast("array<string>")).alias("nouns"),
        *[F.coalesce(F.col(f"_hit.{c}"), F.lit(OTHER)).alias(c) for c in categories],
    )


def _first_come(hits: str) -> Column:
    """The longest hit at the first place, then the next one behind its end, and so on.

    Hits are sorted by place and, at one place, from long to short; a hit that
    occurs twice, as a title does that is stored twice, is taken once.
    """
    start = F.struct(F.lit(0).alias("free"), F.filter(hits, lambda h: F.lit(False)).alias("kept"))
    return F.aggregate(
        hits,
        start,
        lambda state, h: F.when(
            h["at"] >= state["free"],
            F.struct((h["at"] - h["less"]).alias("free"), F.concat(state["kept"], F.array(h)).alias("kept")),
        ).otherwise(state),
    )["kept"]


def contract_categories(titles: DataFrame, dictionary: DataFrame, key: str, whole_words: bool = False) -> DataFrame:
    """Two category levels from the same noun, in the shape of the result table."""
    found = classify(titles, dictionary, ["category1", "category2"], key, whole_words)
    return found.select(*_shape(key), "nouns", "category1", "category2")


def form_categories(titles: DataFrame, dictionary: DataFrame, key: str, whole_words: bool = False) -> DataFrame:
    """One category level, in the shape of the result table."""
    return classify(titles, dictionary, ["category1"], key, whole_words).select(*_shape(key), "nouns", "category1")


def _shape(key: str) -> list[str]:
    return DOCUMENT if key == "documentid" else TEMPLATE


def nouns_as_text(df: DataFrame) -> DataFrame:
    """The noun list as text for sinks without arrays."""
    return df.withColumn("nouns", F.concat_ws(",", "nouns"))
