"""Page order from the links between pages (X6): distributed list ranking.

A crawl opens a listing's first page and follows next links. Landed pages come in no
order, each with the link it holds, so a page's number is how many links a crawl follows
to it. Chains are ranked by pointer doubling: round k knows the pages within 2**k links
of a start, and for every page the one 2**k links on; the former jump along the latter.
A chain of n pages takes about log2(n) rounds of joins, not n, and each round is a
written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions import normalize as nz
from riskloom.functions.text import empty_to_null
from riskloom.sources.staging import discard, staged


def chain_ranks(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(id, rank): how many steps of ``links(id, next)`` lead from ``starts(id)`` to an id, plus 1.

    Each id has one ``next`` at most; a null one ends a chain, and so does one without a
    row of its own, which is in the result if it is linked to. A chain that comes back
    to itself ends there: an id keeps the rank of the first visit, also where chains
    meet. Ids that no start leads to are missing.
    """
    jumps = staged(links.dropna().select("id", "next"), "jumps")
    reached = staged(starts.select("id").dropna().distinct().withColumn("rank", F.lit(1)), "reached")
    known, span = reached.count(), 1
    while True:
        ahead = reached.join(jumps, "id").select(
            F.col("next").alias("id"), (F.col("rank") + span).alias("rank")
        )
        wider = staged(
            reached.unionByName(ahead).groupBy("id").agg(F.min("rank").alias("rank")), "reached"
        )
        discard(reached)
        reached, before, known = wider, known, wider.count()
        # All within ``span`` links were known, so nothing new is nothing further on.
        if known == before:
            discard(jumps)
            return reached
        on = jumps.select(F.col("id").alias("next"), F.col("next").alias("_on"))
        further = staged(jumps.join(on, "next").select("id", F.col("_on").alias("next")), "jumps")
        discard(jumps)
        jumps, span = further, 2 * span


def opens_listing(url: Column) -> Column:
    """Whether a url is that of a listing's first page: it names no item to go on after."""
    return ~F.coalesce(url, F.lit("")).rlike(r"[?&]after=")


def page_numbers(
    pages: DataFrame,
    listing: list[str],
    first: Column | None = None,
    base: str = nz.BASE_URL,
) -> DataFrame:
    """(``listing``, url, page_no) of the pages that a crawl reaches, from parsed pages.

    ``pages(listing..., url, status, attempt, next)`` hold each page's next link, of the
    first attempt that has one. ``first`` tells first pages; by default their url says so.
    A page that was never received has no link: it has a number, and those behind it
    have none and are missing, as are pages that only link to each other.
    """
    found = F.min(F.when(F.col("next").isNotNull(), F.struct("attempt", "next")))
    link = nz.resolve_url(F.col("_link.next"), F.lit(None), base)
    nodes = staged(
        pages.groupBy(*listing, "url")
        .agg(found.alias("_link"))
        .select(
            *listing,
            "url",
            F.to_json(F.struct(*listing, "url")).alias("id"),
            empty_to_null(link).alias("_next"),
        ),
        "pages",
    )
    target = F.to_json(F.struct(*listing, F.col("_next").alias("url")))
    links = nodes.where("_next is not null").select("id", target.alias("next"))
    starts = nodes.where(opens_listing(F.col("url")) if first is None else first)
    ranks = chain_ranks(links, starts)
    return nodes.join(ranks, "id").select(*listing, "url", F.col("rank").cast("long").alias("page_no"))
