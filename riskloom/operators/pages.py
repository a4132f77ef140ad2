"""Landed listing pages -> posts and history items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.functions import normalize as nz
from riskloom.functions.text import empty_to_null
from riskloom.operators.chains import page_numbers
from riskloom.operators.select import drop_invalid, drop_promoted, prefix_until_old
from riskloom.operators.skew import BROADCAST_KEYS, having_few
from riskloom.schemas import HISTORY, POST
from riskloom.sources.listing_html import ATTRIBUTES, TEXTS, parse_listing

MAX_ATTEMPTS = 2
# Statuses that settle a page at once.
USABLE = 200
ABSENT = (403, 404)

_FIELDS = [*ATTRIBUTES, "iso_time", *TEXTS]
_ITEM = T.StructType([T.StructField(name, T.StringType()) for name in _FIELDS])
PARSED = T.StructType(
    [
        T.StructField("next", T.StringType()),
        T.StructField("items", T.ArrayType(_ITEM)),
        T.StructField("error", T.StringType()),
    ]
)


# Not over Arrow, whose batches hold 10,000 rows however long they are: pages go to Python by
# the hundred, so that a worker's memory does not follow the number of pages in its task.
@F.udf(PARSED, useArrow=False)
def parse_page(html: str | None) -> dict:
    """Raw items and next link of a page; a page that fails keeps its error."""
    try:
        return {**parse_listing(html or ""), "error": None}
    except Exception as error:  # noqa: BLE001 - one bad page must not fail the job
        return {"next": None, "items": [], "error": f"{type(error).__name__}: {error}"}


def usable_keys(
    pages: DataFrame,
    listing: list[str] | None = None,
    max_attempts: int = MAX_ATTEMPTS,
) -> DataFrame:
    """(url, attempt) of the page rows a crawl would have used.

    Attempts of a url are taken in order: status 200 is usable, 403 and 404
    mean absent, anything else goes to the next attempt, and a url without a
    usable attempt is absent. With ``listing`` (its key columns) given, pages
    after an absent one of the same listing (by ``page_no``) go too, and the
    listing's columns and ``page_no`` are part of the result: a url may be in
    several listings. Pages without the column ``page_no`` are numbered by their next
    links first, see :func:`numbered_pages`.

    Page bodies are not read.
    """
    if listing and "page_no" not in pages.columns:
        pages = numbered_pages(pages, listing)
    settled = F.col("status").isin(USABLE, *ABSENT)
    outcome = (
        pages.where(F.col("attempt") <= max_attempts)
        .groupBy("url", *([*listing, "page_no"] if listing else []))
        .agg(F.min(F.when(settled, F.struct("attempt", "status"))).alias("_first"))
        .withColumn("_usable", F.coalesce(F.col("_first.status") == USABLE, F.lit(False)))
    )
    usable = outcome.where("_usable")
    keys = ["url"]
    if listing:
        keys = ["url", *listing, "page_no"]
        absent = outcome.where(~F.col("_usable"))
        first_absent = absent.groupBy(*listing).agg(F.min("page_no").alias("_absent"))
        marked = usable.join(first_absent, listing, "left")
        usable = marked.where("_absent is null or page_no < _absent")
    return usable.select(*keys, F.col("_first.attempt").alias("attempt"))


def numbered_pages(pages: DataFrame, listing: list[str]) -> DataFrame:
    """(url, attempt, status, ``listing``, page_no) of pages that next links lead to.

    Pages are best parsed; landed ones are parsed for their links here.
    """
    if "next" not in pages.columns:
        body = F.when(F.col("status") == USABLE, F.col("html"))
        pages = pages.withColumn("next", next_link(body))
    tried = pages.select("url", "attempt", "status", *listing)
    return tried.join(page_numbers(pages, listing), [*listing, "url"])


def usable_pages(
    pages: DataFrame,
    listing: list[str] | None = None,
    max_attempts: int = MAX_ATTEMPTS,
    broadcast_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """The page rows of :func:`usable_keys`, joined once by their unique key.

    Keys are counted first; up to the limit they are broadcast and bodies stay.
    """
    chosen = usable_keys(pages, listing, max_attempts)
    return having_few(_tried(pages), chosen, chosen.columns, broadcast_keys)


def _tried(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("status") == USABLE)


def next_link(html: Column) -> Column:
    """Link of the first ``a`` in ``span.next-button``."""
    return parse_page(html)["next"]


def parsed_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``_items``, ``next`` and ``error`` in place of ``html``.

    Pages without the class names of items and next links anywhere hold neither and are
    not sent to Python; their rows stay, as a crawl's outcome depends on them.
    """
    marked = F.col("html").contains("thing") | F.col("html").contains("next-button")
    held = (F.col("status") == USABLE) & marked
    body = F.when(held, F.col("html"))
    return (
        pages.withColumn("_page", parse_page(body))
        .withColumns({c: F.col(f"_page.{f}") for c, f in (("_items", "items"), ("next", "next"), ("error", "error"))})
        .drop("html", "_page")
    )


def raw_items(pages: DataFrame, *keep: str, usable: DataFrame | None = None) -> DataFrame:
    """One row per ``div.thing``: ``keep`` columns, position and raw fields.

    ``pages`` are landed or parsed. Landed pages without the class name anywhere
    are dropped before they would be sent to Python. Pages are restricted to
    ``usable`` only after parsing, as items are smaller to shuffle than page
    bodies. Columns that only ``usable`` has, such as page numbers, come with it.
    """
    if usable is not None:
        own = [c for c in usable.columns if c in pages.columns]
        pages, keep = _tried(pages), tuple(dict.fromkeys([*keep, *own]))
    parsed = pages
    if "_items" not in pages.columns:
        parsed = pages.where(F.col("html").contains("thing")).withColumn(
            "_items", parse_page(F.col("html"))["items"]
        )
    parsed = parsed.select(*keep, "_items")
    # The outer form, as from the inner one Spark infers a filter on the size of
    # the array and would parse every page a second time for it.
    items = parsed.select(*keep, F.posexplode_outer("_items").alias("item_no", "_item"))
    items = items.where(F.col("item_no").isNotNull())
    raw = items.select(*keep, "item_no", *(F.col(f"_item.{f}").alias(f"raw_{f}") for f in _FIELDS))
    # Keys are unique, so this joins no row twice.
    return raw if usable is None else raw.join(usable, own)


def _created() -> Column:
    return nz.normalize_epoch(F.col("raw_timestamp"), F.col("raw_iso_time"))


def _first_named(*names: Column) -> Column:
    return F.coalesce(*(empty_to_null(n) for n in names))


def extract_posts(
    pages: DataFrame, base: str = nz.BASE_URL, usable: DataFrame | None = None
) -> DataFrame:
    """Posts of landed listing pages ``(html, group_name)``."""
    raw = drop_promoted(raw_items(pages, "group_name", usable=usable), "raw_promoted")
    title = F.coalesce("raw_title", F.lit(""))
    posts = raw.select(
        nz.item_id(F.col("raw_fullname"), F.col("raw_element_id")).alias("id"),
        nz.resolve_url(F.col("raw_permalink"), F.col("raw_link"), base).alias("url"),
        _first_named(F.col("raw_subreddit"), F.col("group_name")).alias("subreddit"),
        _first_named(F.col("raw_author"), F.lit(nz.DELETED_AUTHOR)).alias("author"),
        title.alias("title"),
        nz.compose_text(title, F.col("raw_expando_text")).alias("text"),
        _created().alias("created_utc"),
        F.lit(None).cast("string").alias("language"),
    )
    return drop_invalid(posts).select(*POST.names)


def extract_items(
    pages: DataFrame,
    oldest: float | None = None,
    base: str = nz.BASE_URL,
    usable: DataFrame | None = None,
) -> DataFrame:
    """History items of user pages ``(html, username, kind[, page_no])``.

    With ``oldest`` given, a user's listing ends at its first older item, as a
    crawl of newest-first pages would stop there (L4).
    """
    own = ["page_no"] if "page_no" in pages.columns else []
    paged = own or (usable is not None and "page_no" in usable.columns)
    raw = raw_items(pages, "username", "kind", *own, usable=usable)
    items = raw.select(
        "username",
        nz.item_id(F.col("raw_fullname"), F.col("raw_element_id")).alias("id"),
        nz.resolve_url(F.col("raw_permalink"), F.col("raw_link"), base).alias("url"),
        F.coalesce("raw_subreddit", F.lit("")).alias("subreddit"),
        _first_named(
            F.col("raw_author"), F.col("username"), F.lit(nz.DELETED_AUTHOR)
        ).alias("author"),
        "kind",
        F.coalesce("raw_md_text", F.lit("")).alias("text"),
        _created().alias("created_utc"),
        F.struct(F.col("page_no") if paged else F.lit(0), "item_no").alias("_pos"),
    )
    if oldest is not None:
        # An item that is old ends the listing even if it has no id.
        items = prefix_until_old(items, ["username", "kind"], "_pos", oldest)
    return drop_invalid(items).select(*HISTORY.names)


def page_errors(pages: DataFrame, *keep: str) -> DataFrame:
    """Pages that could not be parsed, with the reason."""
    parsed = pages.select(*keep, parse_page(F.col("html"))["error"].alias("error"))
    return parsed.where("error is not null")
