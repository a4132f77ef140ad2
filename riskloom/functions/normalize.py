"""Field normalisers for landed items."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.text import empty_to_null, strip

# Fixed values.
BASE_URL = "https://old.reddit.com"
DELETED_AUTHOR = "[deleted]"
MILLISECONDS_ABOVE = 10_000_000_000

_INTEGER = r"\A[+-]?\d+(?:_\d+)*\z"
# Date, hour, minute, second, fraction, zone; all but the date may be missing.
_ISO = (
    r"\A(\d{4}-\d{2}-\d{2})(?:[T ](\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?)?"
    r"(Z|[+-]\d{2}(?::?\d{2})?)?)?\z"
)


def _epoch_of_iso(iso: Column) -> Column:
    def part(group: int, default: str) -> Column:
        return F.coalesce(empty_to_null(F.regexp_extract(iso, _ISO, group)), F.lit(default))

    zone = F.regexp_replace(part(6, "Z"), r"\A([+-]\d{2})(\d{2})\z", "$1:$2")
    clock = F.concat_ws(":", part(2, "00"), part(3, "00"), part(4, "00"))
    date = empty_to_null(F.regexp_extract(iso, _ISO, 1))  # null unless all of it matches
    full = F.concat(date, F.lit("T"), clock, F.lit("."), part(5, "0"), zone)
    return F.unix_micros(F.try_to_timestamp(full)) / F.lit(1e6)


def normalize_epoch(ts_attr: Column, iso: Column) -> Column:
    """Epoch seconds from an integer attribute (s or ms), else an ISO time.

    A time without a zone is UTC. Null when neither can be read.
    """
    attr = strip(ts_attr)
    number = F.when(attr.rlike(_INTEGER), F.replace(attr, F.lit("_"), F.lit(""))).try_cast("double")
    seconds = F.when(number > MILLISECONDS_ABOVE, number / F.lit(1000.0)).otherwise(number)
    return F.coalesce(seconds, _epoch_of_iso(iso))


def item_id(fullname: Column, element_id: Column) -> Column:
    """What follows the last underscore of the full name, else of the id."""
    name = F.coalesce(empty_to_null(fullname), empty_to_null(element_id))
    return F.substring_index(name, "_", -1)


def resolve_url(permalink: Column, url: Column, base: str = BASE_URL) -> Column:
    """Absolute link; a leading slash gets the site prefix."""
    link = strip(F.coalesce(empty_to_null(permalink), empty_to_null(url), F.lit("")))
    return F.when(link.startswith("/"), F.concat(F.lit(base), link)).otherwise(link)


def compose_text(title: Column, body: Column) -> Column:
    """Non-empty parts of (title, body), a blank line between them."""
    return F.concat_ws("\n\n", empty_to_null(title), empty_to_null(body))


def post_id(*candidates: Column) -> Column:
    """First non-empty id as text, else the empty string."""
    named = (empty_to_null(c.cast("string")) for c in candidates)
    return F.coalesce(*named, F.lit(""))
