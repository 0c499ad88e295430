"""Cleaning, loading, collection, extraction and incremental queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import film
from checks.film import film_sql
from checks.registry import query, rounded, table
from marquee.functions import text
from marquee.operators import profile, quality, relations
from marquee.operators.dedupe import first_wins, last_wins, merge_objects, not_yet_loaded
from marquee.operators.dimensions import extend_dimension
from marquee.plans import collect, features, load
from marquee.session import materialise, scratch_path
from marquee.sources import pages as page_source
from marquee.sources import payloads, tables, titles
from marquee.streaming import ingest

_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_LINE_ORDER = "l_partkey {0}, l_suppkey {0}, l_quantity {0}, l_extendedprice {0}, l_discount {0}, l_tax {0}, l_returnflag {0}, l_linestatus {0}, l_shipdate {0}"


def _one_line_sql(direction: str) -> str:
    order = _LINE_ORDER.format(direction)
    return (
        f"SELECT {_LINE_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn "
        "FROM lineitem) WHERE rn = 1"
    )


# --- scalar functions -----------------------------------------------------------------------------------------


@query(
    "parse_money",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '3-MEDIUM' THEN NULL ELSE o_totalprice END AS amount,
       CASE o_orderpriority WHEN '3-MEDIUM' THEN NULL WHEN '2-HIGH' THEN 'EUR' ELSE 'USD' END AS currency FROM orders""",
)
def _(spark, sf):
    grouped = F.format_number("o_totalprice", 2)
    priority = F.col("o_orderpriority")
    raw = (
        F.when(priority == "5-LOW", F.concat(F.lit("USD 1.2."), grouped))
        .when(priority == "3-MEDIUM", F.lit(""))
        .when(priority == "2-HIGH", F.concat(F.lit("EUR "), grouped))
        .otherwise(F.concat(F.lit("USD "), grouped))
    )
    orders = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return orders.select(
        "o_orderkey",
        text.parse_money(F.col("raw")).cast("double").alias("amount"),
        text.money_currency(F.col("raw")).alias("currency"),
    )


@query(
    "split_tokens",
    """WITH t AS (SELECT p_partkey, list_filter([trim(x) FOR x IN string_split(replace(p_name, ' ', ' ,, ') || ' , ' || p_type || ',', ',')], lambda x: x <> '') AS l FROM part)
       SELECT p_partkey, CAST(i AS INTEGER) AS position, l[i] AS token FROM t, unnest(range(1, len(l) + 1)) AS u(i)""",
)
def _(spark, sf):
    raw = F.concat(F.regexp_replace("p_name", " ", " ,, "), F.lit(" , "), "p_type", F.lit(","))
    listed = table(spark, sf, "part").select("p_partkey", text.tokens(raw).alias("l"))
    rows = listed.select("p_partkey", F.posexplode("l").alias("p", "token"))
    return rows.select("p_partkey", (F.col("p") + 1).alias("position"), "token")


@query(
    "typed_fields",
    """SELECT o_orderkey, CAST(trunc(o_totalprice) AS INTEGER) AS votes, o_orderstatus = 'F' AS nominated,
       CASE WHEN o_orderstatus = 'F' THEN 'Sim' ELSE 'Não' END AS flag,
       CASE WHEN o_orderstatus <> 'F' THEN '' WHEN o_orderpriority = '1-URGENT' THEN '🏆 Vencedor' ELSE '🎬 Indicado' END AS status,
       'USD ' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS money, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def _(spark, sf):
    nominated = F.col("o_orderstatus") == "F"
    said = F.when(nominated, F.lit(" SIM ")).otherwise(F.lit("Não"))
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        text.whole_number(F.col("o_totalprice").cast("string")).alias("votes"),
        text.is_affirmative(said).alias("nominated"),
        text.yes_no(nominated).alias("flag"),
        text.award_status(nominated, F.col("o_orderpriority") == "1-URGENT").alias("status"),
        text.format_money(F.floor("o_totalprice"), F.lit("USD")).alias("money"),
        text.date_from_parts(F.year(day), F.month(day), F.dayofmonth(day)).alias("day"),
    )


@query(
    "payload_fields",
    """SELECT CAST(o_orderkey AS VARCHAR) AS imdb_id, o_orderstatus || ', ' || o_orderpriority AS countries, CAST(NULL AS VARCHAR) AS languages,
       'USD ' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT)) AS budget, CAST(NULL AS VARCHAR) AS worldwide_gross,
       'EUR ' || format('{:,}', o_custkey) AS domestic_gross, CAST(NULL AS VARCHAR) AS opening_gross,
       strftime(o_orderdate, '%Y-%m-%d') AS weekend_end_date,
       CAST(floor(o_totalprice / 5000) AS INTEGER) AS metascore, o_orderpriority AS synopsis FROM orders""",
)
def _(spark, sf):
    return payloads.payload_fields(staged_payloads(spark, sf))


def staged_payloads(spark, sf):
    """Stored title and box office answers as JSON text."""
    named = lambda *cs: F.array(*[F.struct(c.alias("name")) for c in cs])
    money = lambda amount, currency: F.struct(amount.cast("string").alias("amount"), F.lit(currency).alias("currency"))
    day = F.col("o_orderdate")
    title = F.struct(
        named(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("originCountries"),
        F.struct(F.floor(F.col("o_totalprice") / 5000).alias("score")).alias("metacritic"),
        F.col("o_orderpriority").alias("plot"),
    )
    box = F.struct(
        money(F.floor("o_totalprice"), "USD").alias("productionBudget"),
        money(F.col("o_custkey"), "EUR").alias("domesticGross"),
        F.struct(F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day")).alias("weekendEndDate"),
    )
    key = F.col("o_orderkey").cast("string").alias("imdb_id")
    return table(spark, sf, "orders").select(key, F.to_json(title).alias("title_json"), F.to_json(box).alias("box_json"))


@query(
    "event_payload",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


# --- pages ----------------------------------------------------------------------------------------------------

_PAGE_CARD = r'(?s)<li><a href="[^"]*">([^<]*)</a></li>'
_PAGE_COUNT = r"(?i)(\d+)"
_PAGE_TEXT_SQL = r"regexp_replace(regexp_replace(html, '(?is)<(?:script|style)\b.*?</(?:script|style)\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g')"


@query(
    "page_scores",
    rf"""WITH d AS (SELECT page_id, TRY_CAST(nullif(regexp_extract({_PAGE_TEXT_SQL}, '(?i)(\d+)', 1), '') AS INTEGER) AS declared,
         regexp_extract_all(html, '(?s)<li><a href="[^"]*">([^<]*)</a></li>', 1) AS cards FROM pages)
         SELECT page_id, declared, CASE WHEN declared IS NOT NULL THEN array_to_string([trim(x) FOR x IN cards[1:declared]], '|') END AS cards FROM d""",
)
def _(spark, sf):
    found = page_source.review_scores(table(spark, sf, "pages"), count_pattern=_PAGE_COUNT, card_pattern=_PAGE_CARD)
    return found.withColumn("cards", F.array_join("cards", "|"))


@query(
    "pages_without_count",
    rf"""SELECT page_id AS id, 'review count not found' AS reason FROM pages WHERE TRY_CAST(nullif(regexp_extract({_PAGE_TEXT_SQL}, '(?i)(\d+)', 1), '') AS INTEGER) IS NULL""",
)
def _(spark, sf):
    found = page_source.review_scores(table(spark, sf, "pages"), count_pattern=_PAGE_COUNT, card_pattern=_PAGE_CARD)
    return page_source.pages_without_count(found)


@query(
    "page_links",
    r"""WITH h AS (SELECT page_id, url, nullif(regexp_extract(html, '(?s)<a[^>]*href="([^"]+)"', 1), '') AS href FROM pages),
        l AS (SELECT page_id, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
          WHEN starts_with(href, '/') THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href END AS link FROM h)
        SELECT page_id, link, CASE WHEN contains(split_part(link, '?', 1), '.example.') THEN split_part(split_part(link, '?', 1), '.example.', 2) END AS slug,
        '.example.' || CASE WHEN contains(split_part(link, '?', 1), '.example.') THEN split_part(split_part(link, '?', 1), '.example.', 2) END || '/critic-reviews/' AS reviews_url FROM l""",
)
def _(spark, sf):
    return page_source.review_links(table(spark, sf, "pages"), link_pattern=r'(?s)<a[^>]*href="([^"]+)"', marker=".example.")


def _review_pages(spark, sf):
    """The given pages, each between review cards and a block of links as review sites write them."""
    n = F.col("page_id")
    card = lambda text: F.concat(F.lit('<div class="x c-siteReviewHeader_reviewScore y"><a><div><div>'), text, F.lit("</div></div></a></div><p><span>7</span></p>"))
    span = lambda text: F.concat(F.lit("<span> "), text.cast("string"), F.lit("&nbsp;</span>"))
    cards = [card(span(n % 101)), card(F.lit("tbd")), card(span((n * 7) % 101)), card(F.lit("&#56;&#x34;"))]
    title = F.concat(
        F.lit('<div data-testid="critic-reviews-title" id="t"><div><div>a</div><div><a href="/wrong">w</a></div></div><div><div><a href="/no">n</a></div><div><span><a class="l" href="https://www.metacritic.com/movie/film-'),
        n.cast("string"),
        F.lit('?a=1&amp;b=2">m</a></span></div></div></div><div><div></div><div><a href="/after">z</a></div></div>'),
    )
    html = F.concat(F.lit("<body><p>Showing "), (n % 6).cast("string"), F.lit(" <b>Critic Reviews</b></p>"), *cards, title, F.col("html"))
    return table(spark, sf, "pages").select("page_id", "url", html.alias("html"))


@query(
    "page_cards",
    """SELECT page_id, i AS sample_index, CAST(CASE i WHEN 1 THEN page_id % 101 WHEN 3 THEN (page_id * 7) % 101 WHEN 4 THEN 84 END AS INTEGER) AS score
       FROM pages, (VALUES (1), (2), (3), (4)) AS t(i) WHERE i <= page_id % 6""",
)
def _(spark, sf):
    """Cards by the default markers: some without a score, some without a span, and numbers outside of cards."""
    return page_source.score_rows(page_source.review_scores(_review_pages(spark, sf)))


@query(
    "page_card_rejects",
    "SELECT page_id AS id, 2 AS sample_index, 'tbd' AS text, 'score is no number' AS reason FROM pages WHERE page_id % 6 >= 2",
)
def _(spark, sf):
    return page_source.score_rejects(page_source.review_scores(_review_pages(spark, sf)))


@query(
    "page_block_links",
    """SELECT page_id, 'https://www.metacritic.com/movie/film-' || page_id || '?a=1&b=2' AS link, 'film-' || page_id AS slug,
       'https://www.metacritic.com/movie/film-' || page_id || '/critic-reviews/' AS reviews_url FROM pages""",
)
def _(spark, sf):
    """The link of the second block of the second block, not the first link of the page."""
    return page_source.review_links(_review_pages(spark, sf))


# --- deduplication, dimensions, keys --------------------------------------------------------------------------


@query("dedupe_first", _one_line_sql("ASC"))
def _(spark, sf):
    kept = first_wins(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], film.LINE_ORDER)
    return kept.select(*_LINE_COLUMNS.split(", "))


@query("dedupe_last", _one_line_sql("DESC"))
def _(spark, sf):
    kept = last_wins(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], film.LINE_ORDER)
    return kept.select(*_LINE_COLUMNS.split(", "))


@query(
    "insert_ignore",
    _one_line_sql("ASC") + " AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')",
)
def _(spark, sf):
    lines = table(spark, sf, "lineitem")
    there = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    existing = lines.join(there, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")
    fresh = not_yet_loaded(lines, existing, ["l_orderkey", "l_linenumber"], film.LINE_ORDER)
    return fresh.select(*_LINE_COLUMNS.split(", "))


@query(
    "dim_people",
    "SELECT row_number() OVER (ORDER BY min(o_orderkey)) AS id, 'Person ' || o_custkey AS name FROM orders GROUP BY o_custkey",
)
def _(spark, sf):
    name = F.concat(F.lit("Person "), F.col("o_custkey").cast("string"))
    return extend_dimension(table(spark, sf, "orders").select(name.alias("name"), F.col("o_orderkey").alias("ordinal")))


@query(
    "merge_objects",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE o_orderstatus END AS status, o_orderpriority AS priority FROM orders""",
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    left = F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority")
    old = orders.select("o_orderkey", left.alias("fields"))
    new = orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", F.create_map(F.lit("status"), F.lit("new")).alias("fields"))
    merged = merge_objects(old, new, "o_orderkey")
    return merged.select("o_orderkey", F.col("fields")["status"].alias("status"), F.col("fields")["priority"].alias("priority"))


@query(
    "fk_orphans",
    "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(spark, sf):
    return relations.orphans(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", table(spark, sf, "lineitem"), "l_orderkey")


_ERRORS_SQL = "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'HOUSEHOLD'"


def _error_keys(spark, sf):
    bad = (F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "HOUSEHOLD")
    return table(spark, sf, "customer").filter(bad).select(F.col("c_custkey").alias("o_custkey"))


@query("skip_errors", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN ({_ERRORS_SQL})")
def _(spark, sf):
    return relations.without_keys(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), _error_keys(spark, sf), "o_custkey")


@query("skip_report", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({_ERRORS_SQL})")
def _(spark, sf):
    return relations.only_keys(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), _error_keys(spark, sf), "o_custkey")


@query(
    "cascade_delete",
    film_sql("SELECT movie_id, person_id, role FROM movie_people WHERE movie_id NOT IN (SELECT imdb_id FROM movies WHERE nominated_oscar)"),
)
def _(spark, sf):
    frames = {"movies": film.movies(spark, sf), "movie_people": film.movie_people(spark, sf)}
    left = relations.delete_cascade(frames, frames["movies"].filter("nominated_oscar"), ["movie_people"])
    return left["movie_people"].select("movie_id", "person_id", "role")


@query(
    "expectations",
    """SELECT 'lineitem' AS "table", 'required:l_orderkey' AS rule, count(*) FILTER (l_orderkey IS NULL) AS violations FROM lineitem
       UNION ALL SELECT 'lineitem', 'rule:discount_range', count(*) FILTER (NOT l_discount BETWEEN 0 AND 0.05) FROM lineitem
       UNION ALL SELECT 'lineitem', 'rule:flag_domain', count(*) FILTER (l_returnflag NOT IN ('R', 'N')) FROM lineitem
       UNION ALL SELECT 'lineitem', 'unique:l_orderkey,l_linenumber', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
       UNION ALL SELECT 'lineitem', 'parent:l_partkey', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
       UNION ALL SELECT 'orders', 'unique:o_custkey', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)""",
)
def _(spark, sf):
    frames = {n: table(spark, sf, n) for n in ("lineitem", "orders", "part")}
    rules = {
        "lineitem": quality.Expectations(
            required=["l_orderkey"],
            unique=[["l_orderkey", "l_linenumber"]],
            rules={"discount_range": F.col("l_discount").between(0, 0.05), "flag_domain": F.col("l_returnflag").isin("R", "N")},
            parents={"l_partkey": ("part", "p_partkey")},
        ),
        "orders": quality.Expectations(unique=[["o_custkey"]]),
    }
    return quality.report(frames, rules)


@query(
    "quarantine",
    """SELECT l_returnflag, count(*) AS n FROM lineitem WHERE NOT l_discount BETWEEN 0 AND 0.05 OR l_quantity > 40 GROUP BY l_returnflag""",
)
def _(spark, sf):
    rules = {"discount_range": F.col("l_discount").between(0, 0.05), "quantity_range": F.col("l_quantity") <= 40}
    _, bad = quality.quarantine(table(spark, sf, "lineitem"), quality.Expectations(required=["l_orderkey"], rules=rules))
    return bad.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


@query(
    "quarantine_keys",
    """WITH k AS (SELECT l_orderkey, l_suppkey, l_quantity, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) AS n FROM lineitem)
       SELECT l_orderkey, l_suppkey, CASE WHEN n > 1 THEN 'unique:l_orderkey,l_suppkey' ELSE '' END || CASE WHEN n > 1 AND l_quantity > 40 THEN ' ' ELSE '' END
       || CASE WHEN l_quantity > 40 THEN 'rule:quantity_range' ELSE '' END AS reasons, count(*) AS n FROM k WHERE n > 1 OR l_quantity > 40 GROUP BY ALL""",
)
def _(spark, sf):
    """All rows of a key that comes twice, next to rows that break a rule."""
    e = quality.Expectations(unique=[["l_orderkey", "l_suppkey"]], rules={"quantity_range": F.col("l_quantity") <= 40})
    _, bad = quality.quarantine(table(spark, sf, "lineitem"), e)
    reasons = F.array_join(F.reverse(F.array_sort("reasons")), " ")
    return bad.groupBy("l_orderkey", "l_suppkey", reasons.alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "quarantine_parents",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') THEN 'parent:o_custkey' ELSE '' END AS lost,
       CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 30) THEN 'parent:o_orderkey' ELSE '' END AS unsold FROM orders
       WHERE lost <> '' OR unsold <> ''""",
)
def _(spark, sf):
    """Rows that refer to what is not there, by two references."""
    parents = {
        "customer": table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'"),
        "lineitem": table(spark, sf, "lineitem").filter("l_quantity > 30"),
    }
    e = quality.Expectations(parents={"o_custkey": ("customer", "c_custkey"), "o_orderkey": ("lineitem", "l_orderkey")})
    _, bad = quality.quarantine(table(spark, sf, "orders"), e, parents)
    named = lambda r: F.when(F.array_contains("reasons", r), r).otherwise("")
    return bad.select("o_orderkey", "o_custkey", named("parent:o_custkey").alias("lost"), named("parent:o_orderkey").alias("unsold"))


# --- the load -------------------------------------------------------------------------------------------------


def raw_catalogue(spark, sf):
    """Catalogue rows as text: an order is a film, its parts are genres and people."""
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type", "p_brand")
    lines = film.lines(spark, sf).join(parts, "l_partkey").withColumn("person", F.concat(F.lit("Person "), F.col("l_partkey").cast("string")))
    listed = lambda where, name: F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.when(where, F.struct("l_linenumber", F.col(name).alias("s"))))), lambda e: e["s"]
        ),
        " ,, ",
    )
    every, flag = F.lit(True), F.col("l_returnflag")
    lists = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        listed(every, "p_type").alias("Gêneros"),
        listed(flag == "R", "person").alias("Diretores"),
        listed(flag == "N", "person").alias("Roteiristas"),
        listed(flag == "A", "person").alias("Elenco Principal"),
        listed(every, "p_brand").alias("Países"),
    )
    price, text_of = F.col("o_totalprice"), lambda c: c.cast("string")
    money = F.concat(F.lit("USD "), F.format_number(price, 2))
    values = {
        "ID IMDb": text_of(F.col("o_orderkey")),
        "Título Original": F.concat(F.lit("Title "), text_of(F.col("o_orderkey"))),
        "Título Brasileiro": F.lit(None).cast("string"),
        "Ano Lançamento": text_of(F.year("o_orderdate")),
        "Nota IMDb": text_of(F.floor(price / 5000) / 10),
        "Votos": text_of(price),
        "Duração (min)": text_of(F.dayofyear("o_orderdate") + 60),
        "Indicado Oscar": F.when(F.col("o_orderstatus") == "F", " sim ").otherwise("Não"),
        "Vencedor Oscar": F.lit("Não"),
        "Ano Cerimônia Oscar": F.lit(None).cast("string"),
        "Status Oscar": F.lit(None).cast("string"),
        "Idiomas": F.lit(None).cast("string"),
        "Orçamento": F.lit(None).cast("string"),
        "Bilheteria Mundial": money,
        "Bilheteria Doméstica": F.lit("USD"),
        "Metascore": F.lit(None).cast("string"),
        "Sinopse": F.lit(None).cast("string"),
    }
    base = table(spark, sf, "orders").select("o_orderkey", *[v.alias(k) for k, v in values.items()])
    return base.join(lists, "o_orderkey", "left").withColumnRenamed("o_orderkey", "ordinal")


@query(
    "load_movies",
    film_sql(
        "SELECT m.imdb_id, m.release_year, round(CAST(m.imdb_rating AS DOUBLE), 6) AS imdb_rating, m.imdb_votes, m.runtime_minutes, "
        "m.nominated_oscar, round(o_totalprice, 6) AS worldwide_gross FROM movies m JOIN orders ON CAST(o_orderkey AS VARCHAR) = m.imdb_id"
    ),
)
def _(spark, sf):
    raw = raw_catalogue(spark, sf)
    wide = load.typed_movies(raw).join(load.typed_box_office(raw).drop("ordinal").withColumnRenamed("movie_id", "imdb_id"), "imdb_id")
    columns = ["imdb_id", "release_year", "imdb_rating", "imdb_votes", "runtime_minutes", "nominated_oscar", "worldwide_gross"]
    return rounded(wide.select(*columns))


_PEOPLE_SQL = """, flagged AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS movie_id, 'Person ' || l_partkey AS person_name, l_linenumber,
    CASE l_returnflag WHEN 'R' THEN 'director' WHEN 'N' THEN 'writer' ELSE 'cast' END AS role FROM lines),
placed AS (SELECT *, row_number() OVER (PARTITION BY movie_id, role ORDER BY l_linenumber) AS pos FROM flagged)
"""


@query(
    "load_people",
    film_sql("").rstrip()
    + _PEOPLE_SQL
    + "SELECT movie_id, person_name, role, CASE WHEN role = 'cast' THEN CAST(min(pos) AS INTEGER) END AS cast_order FROM placed GROUP BY movie_id, person_name, role",
)
def _(spark, sf):
    scores = film.rating_samples(spark, sf).select(F.col("movie_id").alias("film"), "sample_index", F.col("score_value").alias("score"))
    built, _ = load.build_tables(raw_catalogue(spark, sf), scores)
    named = relations.bridge_with_names(built["movie_people"], built["people"], "person_id", "person_name")
    return named.select("movie_id", "person_name", "role", "cast_order")


@query(
    "load_genres",
    film_sql("").rstrip()
    + """, seen AS (SELECT p_type AS name, min(struct_pack(o := l_orderkey, p := l_linenumber)) AS f FROM lines JOIN part ON p_partkey = l_partkey GROUP BY p_type)
SELECT row_number() OVER (ORDER BY f) AS id, name FROM seen""",
)
def _(spark, sf):
    named = load.mentions(raw_catalogue(spark, sf), "Gêneros")
    return extend_dimension(named, None, ["ordinal", "block", "position"])


@query(
    "orphan_samples",
    film_sql("SELECT movie_id, score_value, sample_index FROM rating_samples WHERE movie_id IN (SELECT imdb_id FROM movies WHERE NOT nominated_oscar)"),
)
def _(spark, sf):
    scores = film.rating_samples(spark, sf).select(F.col("movie_id").alias("film"), "sample_index", F.col("score_value").alias("score"))
    known = film.movies(spark, sf).filter("nominated_oscar")
    lost = relations.orphans(load.load_samples(scores), "movie_id", known, "imdb_id")
    return lost.select("movie_id", "score_value", "sample_index")


# --- the collection -------------------------------------------------------------------------------------------


def title_rows(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("tt"), F.col("o_orderkey").cast("string")).alias("unique_id"),
        F.when(F.col("o_orderstatus") == "P", "series").otherwise("movie").alias("title_type"),
        F.concat(F.lit("Title "), F.col("o_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("Original "), F.col("o_orderkey").cast("string")).alias("original_title"),
        F.year("o_orderdate").alias("start_year"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.floor(F.col("o_totalprice") / 5000) / 10).alias("rating"),
        F.floor("o_totalprice").alias("votes"),
        (F.dayofyear("o_orderdate") + 60).alias("runtime"),
    )


@query(
    "popular_titles",
    """SELECT o_orderkey AS id, CAST(floor(o_totalprice) AS BIGINT) AS votes, CAST(year(o_orderdate) AS INTEGER) AS start_year FROM orders
       WHERE o_orderstatus <> 'P' AND floor(o_totalprice) >= 50000 AND o_orderpriority <> '5-LOW' AND year(o_orderdate) BETWEEN 1999 AND 2024""",
)
def _(spark, sf):
    return titles.order_titles(titles.popular_titles(title_rows(spark, sf))).select("id", "votes", "start_year")


def _curated(spark, sf):
    """Several entries per customer, the last one counts."""
    return table(spark, sf, "orders").select(
        F.concat(F.lit("tt"), F.col("o_custkey").cast("string")).alias("unique_id"),
        (F.year("o_orderdate") + 1).alias("ceremony_year"),
        F.concat(F.lit("Local "), F.col("o_orderkey").cast("string")).alias("local_title"),
        (F.col("o_orderpriority") == "1-URGENT").alias("winner"),
        F.col("o_orderkey").alias("ordinal"),
    )


_CURATED_SQL = """SELECT 'tt' || o_custkey AS unique_id, CAST(max_by(year(o_orderdate), o_orderkey) + 1 AS INTEGER) AS ceremony_year,
  'Local ' || max(o_orderkey) AS local_title, max_by(o_orderpriority, o_orderkey) = '1-URGENT' AS winner FROM orders GROUP BY o_custkey"""


@query("curated_last_wins", _CURATED_SQL)
def _(spark, sf):
    return titles.curated_by_id(_curated(spark, sf)).drop("ordinal")


def _named_lines(spark, sf):
    return film.lines(spark, sf).select(
        F.col("l_orderkey").alias("title_id"),
        F.concat(F.lit("Person "), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_linenumber").alias("ordering"),
        F.col("l_linenumber").alias("ordinal"),
        F.when(F.col("l_returnflag") == "R", "director").when(F.col("l_returnflag") == "N", "actress").otherwise("actor").alias("principal_category"),
    )


@query(
    "main_cast",
    film_sql("").rstrip()
    + """, p AS (SELECT l_orderkey AS title_id, 'Person ' || l_partkey AS name, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos
FROM lines WHERE l_returnflag <> 'R') SELECT title_id, string_agg(name, ', ' ORDER BY pos) AS main_cast FROM p WHERE pos <= 5 GROUP BY title_id""",
)
def _(spark, sf):
    return titles.cast_list(_named_lines(spark, sf))


@query(
    "director_list",
    film_sql("").rstrip()
    + """ SELECT l_orderkey AS title_id, string_agg('Person ' || l_partkey, ', ' ORDER BY l_linenumber) AS directors FROM lines WHERE l_returnflag = 'R' GROUP BY l_orderkey""",
)
def _(spark, sf):
    directors = _named_lines(spark, sf).filter(F.col("principal_category") == "director")
    return relations.name_list(directors, "title_id", "name", "ordinal", "directors")


def _aliases(spark, sf):
    return table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey"
    ).select(
        F.col("l_orderkey").alias("title_id"),
        F.col("s_nationkey").alias("region_id"),
        F.concat(F.lit("Alias "), F.col("l_partkey").cast("string")).alias("name"),
        F.col("l_partkey").alias("id"),
    )


_ALIAS_SQL = """SELECT l_orderkey AS title_id, 'Alias ' || min(l_partkey) AS local_title FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
  WHERE s_nationkey = 15 GROUP BY l_orderkey"""


@query("first_alias", _ALIAS_SQL)
def _(spark, sf):
    return relations.first_alias(_aliases(spark, sf), 15)


@query(
    "catalogue_assembly",
    film_sql("").rstrip()
    + f""", cur AS ({_CURATED_SQL}), al AS ({_ALIAS_SQL}),
pc AS (SELECT title_id, string_agg(name, ', ' ORDER BY pos) AS main_cast FROM (SELECT l_orderkey AS title_id, 'Person ' || l_partkey AS name,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS pos FROM lines WHERE l_returnflag <> 'R') WHERE pos <= 5 GROUP BY title_id),
di AS (SELECT l_orderkey AS title_id, string_agg('Person ' || l_partkey, ', ' ORDER BY l_linenumber) AS directors FROM lines WHERE l_returnflag = 'R' GROUP BY l_orderkey)
SELECT 'tt' || o_orderkey AS id, 'Title ' || o_orderkey AS title,
  CASE WHEN cur.unique_id IS NOT NULL THEN cur.local_title ELSE coalesce(al.local_title, 'Original ' || o_orderkey) END AS local_title,
  CASE WHEN cur.unique_id IS NOT NULL THEN 'Sim' ELSE 'Não' END AS nominated,
  CASE WHEN cur.winner THEN 'Sim' ELSE 'Não' END AS winner,
  coalesce(CAST(cur.ceremony_year AS VARCHAR), '') AS ceremony,
  CASE WHEN cur.unique_id IS NULL THEN '' WHEN cur.winner THEN '🏆 Vencedor' ELSE '🎬 Indicado' END AS status,
  coalesce(directors, '') AS directors, coalesce(main_cast, '') AS main_cast
FROM orders LEFT JOIN cur ON cur.unique_id = 'tt' || o_orderkey LEFT JOIN al ON al.title_id = o_orderkey
LEFT JOIN pc ON pc.title_id = o_orderkey LEFT JOIN di ON di.title_id = o_orderkey""",
)
def _(spark, sf):
    people = _named_lines(spark, sf)
    directors = people.filter(F.col("principal_category") == "director").select("title_id", "name", "ordinal")
    names = {"genres": directors, "directors": directors, "writers": directors, "principals": people}
    payload = staged_payloads(spark, sf)
    rows, _ = collect.assemble(title_rows(spark, sf), _curated(spark, sf), names, _aliases(spark, sf), payload)
    picked = {
        "ID IMDb": "id",
        "Título Original": "title",
        "Título Brasileiro": "local_title",
        "Indicado Oscar": "nominated",
        "Vencedor Oscar": "winner",
        "Ano Cerimônia Oscar": "ceremony",
        "Status Oscar": "status",
        "Diretores": "directors",
        "Elenco Principal": "main_cast",
    }
    return rows.select(*[F.col(f"`{k}`").alias(v) for k, v in picked.items()])


# --- loaders and SQL ------------------------------------------------------------------------------------------


@query(
    "people_loader",
    film_sql("SELECT movie_id, name AS person_name, person_id, role, cast_order FROM movie_people JOIN people ON id = person_id"),
)
def _(spark, sf):
    return tables.load_people_data({"people": film.people(spark, sf), "movie_people": film.movie_people(spark, sf)})[1]


@query(
    "custom_query",
    "SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_totalprice >= 100000 GROUP BY o_orderstatus",
)
def _(spark, sf):
    table(spark, sf, "orders").createOrReplaceTempView("custom_orders")
    sql = "SELECT o_orderstatus AS status, count(*) AS n FROM custom_orders WHERE o_totalprice >= :low GROUP BY o_orderstatus"
    return tables.run_custom_query(spark, sql, {"low": 100000})


# --- incremental ----------------------------------------------------------------------------------------------


def _outcomes(events):
    """Events as fetch outcomes: a user is a key, an error event a failure."""
    failed = F.when(F.col("event_type") == "error", F.when(F.col("value") > 10, "Timeout").otherwise("parse"))
    return events.select(
        F.col("user_id").cast("string").alias("id"), F.col("value"), failed.alias("error"), F.col("event_id").alias("attempt")
    )


@query(
    "stream_ingest",
    """SELECT CAST(user_id AS VARCHAR) AS id, arg_min(value, event_id) AS value, min(event_id) AS attempt FROM events
       WHERE event_type <> 'error' GROUP BY user_id""",
)
def _(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    root = scratch_path(spark, "ingest")
    ingest.ingest_available(spark, _outcomes(stream), f"{root}/results", f"{root}/rejects", f"{root}/checkpoint")
    return ingest.read_results(spark, f"{root}/results", "id STRING, value DOUBLE, attempt BIGINT").drop("bucket")


@query(
    "stream_two_runs",
    """WITH first AS (SELECT CAST(user_id AS VARCHAR) AS id, arg_min(value, event_id) AS value, min(event_id) AS attempt FROM events
         WHERE event_type <> 'error' AND user_id % 3 = 0 GROUP BY user_id),
       later AS (SELECT CAST(user_id AS VARCHAR) AS id, arg_min(value, event_id) AS value, min(event_id) AS attempt FROM events
         WHERE event_type <> 'error' GROUP BY user_id)
       SELECT id, value, attempt, 1 AS run FROM first UNION ALL SELECT id, value, attempt, 2 FROM later WHERE id NOT IN (SELECT id FROM first)""",
)
def _(spark, sf):
    """Two runs through one checkpoint: the second takes the files that came after the first, and keeps earlier results."""
    events = table(spark, sf, "events")
    root = scratch_path(spark, "ingest")
    arrived = lambda n, rows: rows.write.parquet(f"{root}/in/{n}")
    stream = lambda: spark.readStream.schema(events.schema).parquet(f"{root}/in/*")
    places = f"{root}/results", f"{root}/rejects", f"{root}/checkpoint"
    arrived(1, events.filter(F.col("user_id") % 3 == 0))
    ingest.ingest_available(spark, _outcomes(stream()), *places)
    kept = "id STRING, value DOUBLE, attempt BIGINT"
    first = materialise(ingest.read_results(spark, places[0], kept).select("id"))
    arrived(2, events)
    ingest.ingest_available(spark, _outcomes(stream()), *places)
    every = ingest.read_results(spark, places[0], kept).drop("bucket")
    return every.join(first.withColumn("run", F.lit(1)), "id", "left").withColumn("run", F.coalesce("run", F.lit(2)))


@query(
    "retry_pass",
    """WITH last AS (SELECT CAST(user_id AS VARCHAR) AS id, arg_max(event_type, event_id) AS kind, arg_max(value, event_id) AS value, max(event_id) AS attempt
         FROM events GROUP BY user_id)
       SELECT id, CASE WHEN value > 10 THEN 'timeout' ELSE 'other' END AS reason, attempt FROM last
       WHERE kind = 'error' AND id NOT IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase' AND value > 100)""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    outcomes = _outcomes(events)
    recovered = events.filter((F.col("event_type") == "purchase") & (F.col("value") > 100)).select(F.col("user_id").cast("string").alias("id"))
    errors = outcomes.filter(F.col("error").isNotNull())
    return ingest.retry_pass(errors, recovered, outcomes)[1]


@query(
    "pending_keys",
    """SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""",
)
def _(spark, sf):
    keys = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    done = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").cast("string").alias("id"))
    return ingest.pending(keys, done)


@query(
    "named_results",
    """SELECT event_type AS name, arg_max(value, event_id) AS value FROM events WHERE event_type <> 'view' GROUP BY event_type""",
)
def _(spark, sf):
    name = F.when(F.col("event_type") != "view", F.col("event_type")).otherwise("")
    results = table(spark, sf, "events").select(name.alias("name"), "value", F.col("event_id").alias("completed"))
    return ingest.named_results(results).select("name", "value")


@query("first_errors", "SELECT event_id AS id, props AS reason FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 10")
def _(spark, sf):
    errors = table(spark, sf, "events").filter(F.col("event_type") == "error")
    return profile.first_errors(errors.select(F.col("event_id").alias("id"), F.col("props").alias("reason")))


@query(
    "genres_loader",
    film_sql("SELECT movie_id, name AS genre_name, genre_id FROM movie_genres JOIN genres ON id = genre_id"),
)
def _(spark, sf):
    frames = {"genres": film.part_dimension(spark, sf, "p_type"), "movie_genres": film.part_bridge(spark, sf, "p_type", "genre_id")}
    return tables.load_genres_data(frames)[1]


@query(
    "sql_views",
    film_sql("SELECT label, count(*) AS n, CAST(sum(num_cast) AS BIGINT) AS num_cast FROM ml_training_dataset WHERE release_year BETWEEN 1995 AND 1999 GROUP BY label"),
)
def _(spark, sf):
    """The SQL surface: views over the tables, the feature table and its splits."""
    splits = {f"ml_split_{k}": v for k, v in film.SPLITS.items()}
    features.register_views(spark, film.tables(spark, sf), splits, flags=film.FLAGS)
    return tables.run_custom_query(spark, "SELECT label, count(*) AS n, sum(num_cast) AS num_cast FROM ml_split_train GROUP BY label")
