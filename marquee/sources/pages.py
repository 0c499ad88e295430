"""Declared counts, score cards and review links of stored pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import absolute_url, slug_after, strip

# Texts and markers of the review pages.
COUNT_PATTERN = r"(?i)Showing\s+(\d+)\s+Critic Reviews"
CARD_CLASS = "c-siteReviewHeader_reviewScore"
LINK_TITLE = "critic-reviews-title"
SLUG_MARKER = "https://www.metacritic.com/movie/"
REVIEW_PATH = "/critic-reviews/"

# Entities by name; the ampersand last, so that nothing is decoded twice.
_ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&amp;": "&"}

_HIDDEN = r"(?is)<(script|style)\b.*?</\1\s*>"
_CARD = rf'(?i)<[a-z][^>]*\bclass="(?:[^"]*\s)?{CARD_CLASS}(?:\s[^"]*)?"[^>]*>'
_FIRST_TEXT = r"(?s)^(?:\s*<[^/!][^>]*>)*\s*([^<]*)"
_TITLE = rf'(?i)<div\b[^>]*\bdata-testid="{LINK_TITLE}"[^>]*>'
_DIV_OR_LINK = r'(?i)(<div\b[^>]*>|</div\s*>|<a\b[^>]*\bhref="[^"]*")'


def decode_entities(text):
    """Entities by number, then the common ones by name."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(r"(?i)(&#(?:x[0-9a-f]{1,6}|[0-9]{1,7});)"), 1))

    def replaced(acc, entity):
        hexed = F.substring(entity, 3, 1).isin("x", "X")
        digits = F.regexp_extract(entity, r"([0-9a-fA-F]+);", 1)
        number = F.when(hexed, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        return F.replace(acc, entity, F.when(known, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("\ufffd")))

    out = F.aggregate(found, text, replaced)
    for name, value in _ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(value))
    return out


def card_texts(html):
    """The first text of each review card. The page is cut where cards begin, so a card without a score does not take the
    next one's; within a card, what stands after its opening tags is the score, in a span of its own or not."""
    cards = F.split(html, _CARD)
    return F.transform(F.slice(cards, 2, F.size(cards)), lambda c: strip(decode_entities(F.regexp_extract(c, _FIRST_TEXT, 1))))


def second_block_link(html):
    """Address of the first link in the second block of the second block below the title, null if there is none. Blocks are
    counted along the page's division tags: `depth` below the title, and the number of the block at the first two levels."""
    parts = F.split(html, _TITLE, 2)
    steps = F.regexp_extract_all(F.get(parts, F.lit(1)), F.lit(_DIV_OR_LINK), 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("outer"), F.lit(0).alias("inner"), F.lit(None).cast("string").alias("link"))

    def step(at, tag):
        opens, closes = F.lower(F.substring(tag, 1, 4)) == "<div", F.substring(tag, 1, 2) == "</"
        depth = at["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        inside = at["depth"] >= 0  # the title itself is still open
        outer = at["outer"] + F.when(inside & opens & (depth == 1), 1).otherwise(0)
        inner = F.when(inside & opens & (depth == 1), 0).otherwise(at["inner"] + F.when(inside & opens & (depth == 2), 1).otherwise(0))
        here = inside & ~opens & ~closes & (at["depth"] >= 2) & (at["outer"] == 2) & (at["inner"] == 2)
        link = F.coalesce(at["link"], F.when(here, F.regexp_extract(tag, r'(?i)href="([^"]*)"', 1)))
        gone = F.when(inside, depth).otherwise(F.lit(-1))
        return F.struct(gone.alias("depth"), outer.alias("outer"), inner.alias("inner"), link.alias("link"))

    return F.nullif(decode_entities(F.aggregate(steps, start, step, lambda at: at["link"])), F.lit(""))


def visible_text(html):
    """Text of the whole page without scripts, styles and tags."""
    return F.regexp_replace(F.regexp_replace(html, _HIDDEN, " "), r"<[^>]*>", " ")


def review_scores(
    pages: DataFrame, key: str = "page_id", count_pattern: str = COUNT_PATTERN, card_pattern: str | None = None
) -> DataFrame:
    """Per page the declared number of reviews and that many card texts; both null when no number is declared. A pattern for
    cards takes the place of `card_texts`."""
    declared = F.nullif(F.regexp_extract(visible_text(F.col("html")), count_pattern, 1), F.lit("")).try_cast("int")
    found = pages.select(key, declared.alias("declared"), (card_texts(F.col("html")) if card_pattern is None else F.regexp_extract_all("html", F.lit(card_pattern), 1)).alias("cards"))
    texts = F.transform(F.slice("cards", F.lit(1), F.greatest(F.col("declared"), F.lit(0))), strip)
    return found.select(key, "declared", F.when(F.col("declared").isNotNull(), texts).alias("cards"))


def score_rows(found: DataFrame, key: str = "page_id") -> DataFrame:
    """Card texts as numbered whole scores; a text that is no number is null."""
    return found.select(key, F.posexplode("cards").alias("pos", "text")).select(
        key, (F.col("pos") + 1).alias("sample_index"), F.col("text").try_cast("int").alias("score")
    )


def score_rejects(found: DataFrame, key: str = "page_id") -> DataFrame:
    """Cards whose text is no whole number, such as a score that is still to come."""
    rows = found.select(F.col(key).alias("id"), F.posexplode("cards").alias("pos", "text")).filter(F.col("text").try_cast("int").isNull())
    return rows.select("id", (F.col("pos") + 1).alias("sample_index"), "text", F.lit("score is no number").alias("reason"))


def pages_without_count(found: DataFrame, key: str = "page_id") -> DataFrame:
    return found.filter(F.col("declared").isNull()).select(F.col(key).alias("id"), F.lit("review count not found").alias("reason"))


def review_links(pages: DataFrame, key: str = "page_id", link_pattern: str | None = None, marker: str = SLUG_MARKER, path: str = REVIEW_PATH) -> DataFrame:
    """The review site's slug from the link on the page and the address of its review list. A pattern for the link takes the
    place of `second_block_link`."""
    href = second_block_link(F.col("html")) if link_pattern is None else F.nullif(F.regexp_extract("html", link_pattern, 1), F.lit(""))
    linked = pages.select(key, absolute_url(F.col("url"), href).alias("link"))
    slug = slug_after(F.col("link"), marker)
    return linked.select(key, "link", slug.alias("slug"), F.concat(F.lit(marker), slug, F.lit(path)).alias("reviews_url"))
