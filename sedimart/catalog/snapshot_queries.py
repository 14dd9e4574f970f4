"""Snapshot differences, calendar expansion and HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedimart.catalog.registry import Tables, day, moment, query
from sedimart.operators.html import html_lessons, page_parts
from sedimart.operators.snapshots import (
    calendar_expand,
    carry_over,
    dated_events,
    lesson_times,
    missing_pages,
    page_diff,
    snapshot_diff,
)

# Spanish pages are new, German ones gone, French ones changed.
_PAGES_SQL = """
WITH old AS (SELECT url, html FROM pages WHERE NOT contains(url, '/es/')),
new AS (SELECT url, CASE WHEN contains(url, '/fr/') THEN html || '!' ELSE html END AS html FROM pages WHERE NOT contains(url, '/de/'))
"""


def _pages(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.pages.filter(~F.contains("url", F.lit("/es/"))).select("url", "html")
    changed = F.when(F.contains("url", F.lit("/fr/")), F.concat("html", F.lit("!"))).otherwise(F.col("html"))
    new = t.pages.filter(~F.contains("url", F.lit("/de/"))).select("url", changed.alias("html"))
    return old, new


@query(
    "page_diff",
    _PAGES_SQL
    + """SELECT coalesce(new.url, old.url) AS url, CASE WHEN old.html IS NULL THEN 'added' WHEN new.html IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM new FULL OUTER JOIN old ON new.url = old.url WHERE old.html IS NULL OR new.html IS NULL OR old.html <> new.html""",
)
def _(t: Tables) -> DataFrame:
    old, new = _pages(t)
    return page_diff(new, old, "url", "html")


@query("missing_pages", _PAGES_SQL + "SELECT url FROM pages WHERE url NOT IN (SELECT url FROM new)")
def _(t: Tables) -> DataFrame:
    return missing_pages(_pages(t)[1], t.pages)


# Lessons are orders: the place is the list of suppliers, the group the list of parts.  In the new
# snapshot lists are in another order with a repeat; returned goods gain a place, urgent orders are gone.
_LESSONS_SQL = """
WITH lists AS (
  SELECT l_orderkey AS k, list_sort(list(DISTINCT l_suppkey)) AS place, list_sort(list(DISTINCT l_partkey)) AS grp FROM lineitem GROUP BY l_orderkey
), base AS (
  SELECT o_orderkey AS num, o_orderpriority AS subject, o_orderstatus, CASE WHEN o_orderpriority <> '5-LOW' THEN place END AS place, grp
  FROM orders JOIN lists ON k = o_orderkey
), old AS (SELECT num + 1 AS id, num, subject, place, grp FROM base WHERE o_orderstatus <> 'O'),
new AS (
  SELECT num + 1000000000 AS id, num, subject, CASE WHEN o_orderstatus = 'P' THEN list_append(place, -1) ELSE place END AS place, grp
  FROM base WHERE subject <> '1-URGENT'
), diff AS (
  SELECT CASE WHEN l.num IS NOT NULL AND r.num IS NOT NULL THEN 'remember' WHEN l.num IS NULL THEN 'create' ELSE 'delete' END AS action,
         coalesce(r.id, l.id) AS id, coalesce(l.num, r.num) AS num, coalesce(l.subject, r.subject) AS subject, l.id AS old_id
  FROM old l FULL OUTER JOIN new r ON l.subject = r.subject AND l.num = r.num AND list_sort(list_distinct(l.place)) = list_sort(list_distinct(r.place)) AND l.grp = r.grp
)
"""


def _lessons(t: Tables) -> tuple[DataFrame, DataFrame]:
    lists = t.lineitem.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_set("l_suppkey")).alias("place"), F.array_sort(F.collect_set("l_partkey")).alias("group")
    )
    base = t.orders.join(lists, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("num"),
        F.col("o_orderpriority").alias("subject"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("place")).alias("place"),
        "group",
    )
    events = F.array(F.col("num"))
    old = base.filter("o_orderstatus <> 'O'").select(
        (F.col("num") + 1).alias("id"), "num", "subject", "place", "group", events.alias("events_id")
    )
    turned = F.concat(F.reverse("place"), F.slice("place", 1, 1))
    place = F.when(F.col("o_orderstatus") == "P", F.array_append(turned, F.lit(-1).cast("bigint"))).otherwise(turned)
    new = base.filter("subject <> '1-URGENT'").select(
        (F.col("num") + 1_000_000_000).alias("id"), "num", "subject", place.alias("place"), F.reverse("group").alias("group"),
        F.array().cast("array<bigint>").alias("events_id"),
    )
    return old, new


def _diff(t: Tables) -> DataFrame:
    return snapshot_diff(*_lessons(t), ["subject", "num"], ["place", "group"], ["events_id"], compat=True)


@query("snapshot_diff", _LESSONS_SQL + "SELECT action, id, num, subject FROM diff")
def _(t: Tables) -> DataFrame:
    return _diff(t).select("action", "id", "num", "subject")


@query(
    "carry_over",
    _LESSONS_SQL
    + """SELECT new.id, CASE WHEN d.id IS NULL THEN '' ELSE CAST(d.num AS VARCHAR) END AS events
FROM new LEFT JOIN (SELECT id, num FROM diff WHERE action = 'remember') d ON d.id = new.id""",
)
def _(t: Tables) -> DataFrame:
    new = _lessons(t)[1]
    done = carry_over(new, _diff(t), "events_id")
    return done.select("id", F.array_join(F.col("events_id").cast("array<string>"), "|").alias("events"))


_WEEKLY_SQL = """
WITH weekly AS (
  SELECT p_partkey AS id, p_brand AS subject, p_size % 7 AS weekday, p_type <> 'PROMO' AS odd, p_type <> 'SMALL' AS even, p_name FROM part
), dates AS (
  SELECT CAST(d AS DATE) AS d FROM range(TIMESTAMP '1995-02-08', TIMESTAMP '1995-06-01', INTERVAL 1 DAY) r(d)
), dated AS (
  SELECT id, subject, p_name, d FROM weekly JOIN dates ON isodow(d) - 1 = weekday
  WHERE CASE WHEN (date_diff('day', DATE '1995-02-06', date_trunc('week', d)) // 7) % 2 = 0 THEN odd ELSE even END
)
"""


def _weekly(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_brand").alias("subject"),
        F.pmod("p_size", F.lit(7)).alias("weekday"),
        (F.col("p_type") != "PROMO").alias("odd"),
        (F.col("p_type") != "SMALL").alias("even"),
        F.lit("9:00").alias("start"),
        F.lit("10:35").alias("end"),
        F.array(F.lit(1)).alias("teacher"),
        F.array("p_size").alias("group"),
        F.array("p_partkey").alias("place"),
    )


@query("calendar_expand", _WEEKLY_SQL + "SELECT id, subject, strftime(d, '%Y-%m-%d') AS date FROM dated")
def _(t: Tables) -> DataFrame:
    dated = calendar_expand(_weekly(t), "1995-02-08", "1995-05-31", "1995-02-07")
    return dated.select("id", "subject", day("date").alias("date"))


@query(
    "dated_events",
    _WEEKLY_SQL
    + """SELECT id, subject, strftime(d, '%Y-%m-%d') || ' 09:00:00.000000' AS "start", strftime(d, '%Y-%m-%d') || ' 10:35:00.000000' AS "end"
FROM weekly LEFT JOIN (SELECT id, d FROM dated) USING (id)""",
)
def _(t: Tables) -> DataFrame:
    weekly = _weekly(t)
    dated = lesson_times(calendar_expand(weekly, "1995-02-08", "1995-05-31", "1995-02-07"))
    events = dated_events(weekly, dated)
    return events.select("id", "subject", moment("start").alias("start"), moment("end").alias("end"))


# A timetable page per supplier: four days of four slots, the fourth day without its delimiter.
_ROW_KINDS = """
CASE pmod(s_suppkey + d + s, 4)
  WHEN 0 THEN concat('<tr><td class="tdtime">t</td><td class="tditem1">A', d, s, ' <b>x &amp; y</b></td></tr>')
  WHEN 1 THEN concat('<tr><td class="tdtime">t</td><td class="tdsmall1">O', d, s, '</td></tr><tr><td class="tdsmall1 wide">E', d, s, '</td></tr>')
  WHEN 2 THEN concat('<tr><td class="tdtime">t</td><td class="tditem1"><table><tr><td class="tdsmall0">P', d, s, '</td><td class="tdsmall0">Q', d, s, '<br></td></tr></table></td></tr>')
  ELSE '<tr><td class="tdtime">t</td><td class="tditem1">&nbsp;</td></tr>' END"""
_PAGE = f"""
concat('<html><body><table><tr><td>head</td></tr>\\n<tr><td>group</td><td>G', s_suppkey, '</td><td>times</td>\\n',
  concat_ws('\\n', transform(sequence(0, 3), d -> concat(
    concat_ws('\\n', transform(sequence(0, 3), s -> {_ROW_KINDS})),
    if(d < 3, '\\n<tr><td class="delimiter"></td></tr>', '')))),
  '\\n<td>end</td></table></body></html>')"""


@query(
    "html_lessons",
    """
WITH cells AS (
  SELECT s_suppkey, s_name, d, s, (s_suppkey + d + s) % 4 AS kind FROM supplier, range(3) a(d), range(3) b(s)
), lessons AS (
  SELECT *, unnest(CASE kind WHEN 0 THEN ['A'] WHEN 1 THEN ['O', 'E'] WHEN 2 THEN ['P', 'Q'] ELSE [] END) AS letter FROM cells
)
SELECT s_name AS url, 'G' || s_suppkey AS "group", CAST(d AS INTEGER) AS weekday, CAST(s AS INTEGER) AS num,
       CASE s WHEN 0 THEN '9:00' WHEN 1 THEN '10:50' ELSE '13:30' END AS "start", CASE s WHEN 0 THEN '10:35' WHEN 1 THEN '12:25' ELSE '15:05' END AS "end",
       letter <> 'E' AS odd, letter <> 'O' AS even,
       letter || d || s || CASE letter WHEN 'A' THEN ' <b>x &amp; y</b>' WHEN 'Q' THEN '<br/>' ELSE '' END AS name
FROM lessons""",
)
def _(t: Tables) -> DataFrame:
    pages = t.supplier.select(F.col("s_name").alias("url"), F.expr(_PAGE).alias("raw_html"))
    return html_lessons(pages)


@query(
    "html_extract",
    """
SELECT page_id, CAST(generate_subscripts(hits, 1) - 1 AS INTEGER) AS position, unnest(hits) AS link
FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">', 1) AS hits FROM pages)""",
)
def _(t: Tables) -> DataFrame:
    return page_parts(t.pages, "page_id", "html", '<a href="([^"]*)">', "link")


@query(
    "html_paragraphs",
    """
SELECT page_id, CAST(generate_subscripts(hits, 1) - 1 AS INTEGER) AS position, unnest(hits) AS paragraph
FROM (SELECT page_id, regexp_extract_all(html, '<p>([^<]*)</p>', 1) AS hits FROM pages)""",
)
def _(t: Tables) -> DataFrame:
    return page_parts(t.pages, "page_id", "html", "<p>([^<]*)</p>", "paragraph")
