"""Text linking: documents to benchmark passages, built part titles to part names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, query
from sedimart.operators.containment import contains_join
from sedimart.operators.linking import link_best, token_candidates

_TOKENS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '\\W+'), lambda w: w <> ''))"


@query(
    "contains_link",
    """
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))""",
)
def _(t: Tables) -> DataFrame:
    passages = t.benchmark.select("item_id", F.col("text").alias("passage"))
    return contains_join(t.documents.select("doc_id", "text"), passages, "doc_id", "text", "passage").select("doc_id", "item_id")


@query(
    "contains_best",
    f"""
WITH titles AS (SELECT p_partkey, p_brand || ' ' || p_name || ' ' || p_type AS title FROM part),
words AS (SELECT min(p_partkey) AS word_id, split_part(p_name, ' ', 1 + p_size % 2) AS word FROM part GROUP BY 2)
SELECT p_partkey, word_id FROM (
  SELECT p_partkey, word_id, row_number() OVER (PARTITION BY p_partkey ORDER BY
    len(list_filter({_TOKENS.format('word')}, lambda w: NOT list_contains({_TOKENS.format('title')}, w))) = 0 DESC, word_id) AS rn
  FROM titles JOIN words ON title ILIKE '%' || word || '%') WHERE rn = 1""",
)
def _(t: Tables) -> DataFrame:
    titles = t.part.select("p_partkey", F.concat_ws(" ", "p_brand", "p_name", "p_type").alias("title"))
    word = F.split_part("p_name", F.lit(" "), F.pmod("p_size", F.lit(2)) + 1)
    words = t.part.groupBy(word.alias("word")).agg(F.min("p_partkey").alias("word_id"))
    return link_best(titles, words, "p_partkey", "title", "word_id", "word")


_TITLE_SQL = f"""
WITH titles AS (SELECT p_partkey, {_TOKENS.format("CASE WHEN p_type = 'PROMO' THEN p_brand ELSE p_brand || ' ' || p_name || ' ' || p_type END")} AS d FROM part),
names AS (SELECT p_name, min(p_partkey) AS name_id, {_TOKENS.format('p_name')} AS q FROM part GROUP BY p_name),
hit AS (SELECT p_partkey, name_id FROM titles JOIN names ON len(list_filter(q, lambda w: NOT list_contains(d, w))) = 0)
"""


def _titles(t: Tables) -> tuple[DataFrame, DataFrame]:
    title = F.when(F.col("p_type") == "PROMO", F.col("p_brand")).otherwise(F.concat_ws(" ", "p_brand", "p_name", "p_type"))
    titles = t.part.select("p_partkey", title.alias("title"))
    names = t.part.groupBy("p_name").agg(F.min("p_partkey").alias("name_id"))
    return titles, names


@query("token_link", _TITLE_SQL + "SELECT p_partkey, min(name_id) AS name_id FROM hit GROUP BY p_partkey")
def _(t: Tables) -> DataFrame:
    titles, names = _titles(t)
    return link_best(titles, names, "p_partkey", "title", "name_id", "p_name", contains=False)


@query(
    "token_candidates",
    _TITLE_SQL + "SELECT p_partkey, min(name_id) AS name_id FROM hit JOIN names USING (name_id) GROUP BY p_partkey, list_sort(q)",
)
def _(t: Tables) -> DataFrame:
    titles, names = _titles(t)
    return token_candidates(titles, names, "p_partkey", "title", "name_id", "p_name")


@query(
    "token_link_default",
    _TITLE_SQL
    + """SELECT p_partkey, coalesce(min(name_id), (SELECT min(name_id) FROM names)) AS name_id
FROM titles LEFT JOIN hit USING (p_partkey) GROUP BY p_partkey""",
)
def _(t: Tables) -> DataFrame:
    titles, names = _titles(t)
    return link_best(titles, names, "p_partkey", "title", "name_id", "p_name", contains=False, default_unmatched=True)
