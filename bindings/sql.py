"""SQL fragments for the counterparts, independent of the Spark expressions.

They tokenise and filter lists where Spark matches patterns, and compute
expected extractions from the tables where Spark parses pages.
"""

from __future__ import annotations

from bindings.tables import EPOCH
from riskloom.model import RiskModel

WORD = r"[\p{L}\p{N}_]"
NOT_WORD = r"[^\p{L}\p{N}_]"
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

POSTS = f"""
posts AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, 'https://forum.example/p/' || doc_id AS url,
         source AS subreddit, 'u' || (doc_id % 150) AS author,
         string_split(text, chr(10))[1] AS title, text, doc_id + {EPOCH}e0 AS created_utc,
         CAST(NULL AS VARCHAR) AS language
  FROM documents)"""

ITEMS = f"""
items AS (
  SELECT 'u' || (conv_id % 120) AS username, conv_id || ':' || turn AS id,
         'https://forum.example/c/' || conv_id AS url, 'g' || (conv_id % 7) AS subreddit,
         'u' || (conv_id % 120) AS author,
         CASE WHEN role = 'user' THEN 'submission' ELSE 'comment' END AS kind, text,
         conv_id * 60 + turn + {EPOCH}e0 AS created_utc
  FROM conversations)"""

ACTIVITY = """
activity AS (
  SELECT CAST(event_id AS VARCHAR) AS id, 'u' || user_id AS username, event_type AS subreddit,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'submission' ELSE 'comment' END AS kind,
         epoch_us(ts) / 1e6 AS created_utc, least(value / 1e2, 1e0) AS score
  FROM events)"""

USERS = """
users AS (SELECT 'u' || c_custkey AS username FROM customer)"""


def strip(text: str) -> str:
    return f"regexp_replace({text}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def words(terms: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{t}'" for t in terms) + ")"


def hits(terms: tuple[str, ...], toks: str = "toks") -> str:
    return f"list_filter({toks}, lambda w: w IN {words(terms)})"


def tokens(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '{WORD}+'), lambda w: lower(w))"


def caps_words(text: str) -> str:
    letters = r"regexp_replace(w, '[^\p{L}]', '', 'g')"
    return (
        f"list_filter(regexp_extract_all({text}, '[^{SPACE}]+'), "
        rf"lambda w: regexp_full_match({letters}, '\p{{Lu}}{{3,}}'))"
    )


def threats(model: RiskModel, text: str) -> str:
    """Hits pattern by pattern. Without look-around, every separator is doubled
    so that one match leaves a boundary for the next."""
    doubled = f"regexp_replace({text}, '({NOT_WORD})', '\\1\\1', 'g')"
    lists = []
    for pattern in model.threats:
        core = pattern.removeprefix(r"\b").removesuffix(r"\b").replace("(", "(?:")
        core = core.replace("[' ]?", "(?:''''|@)?").replace(" ", "  ").replace("@", "  ")
        found = f"regexp_extract_all({doubled}, '(?i)(?:^|{NOT_WORD})({core})(?:$|{NOT_WORD})', 1)"
        lists.append(
            f"list_transform({found}, lambda w: regexp_replace(w, '({NOT_WORD}){NOT_WORD}', '\\1', 'g'))"
        )
    joined = lists[0]
    for more in lists[1:]:
        joined = f"list_concat({joined}, {more})"
    return joined


def scored(source: str, model: RiskModel, name: str = "scored", keep: str = "*") -> str:
    """CTEs scoring ``source(title, text, ...)`` into ``name``."""
    w = dict(model.weights)
    return f"""
{name}_0 AS (SELECT {keep}, {strip(f"coalesce(title, '') || chr(10) || CASE WHEN {strip('text')} = '' THEN '' ELSE text END")} AS full_text
  FROM {source}),
{name}_1 AS (SELECT *, {tokens('full_text')} AS toks, {threats(model, 'full_text')} AS th,
    len(regexp_extract_all(full_text, '[^{SPACE}]+')) AS n_words, len({caps_words('full_text')}) AS n_caps
  FROM {name}_0),
{name}_2 AS (SELECT *, {hits(model.violent)} AS vh, {hits(model.hate)} AS hh,
    len({hits(model.intensifiers)}) AS ic FROM {name}_1),
{name}_3 AS (SELECT *, least(len(vh) / {model.lexicon_cap}e0, 1e0) AS violent,
    least(len(hh) / {model.lexicon_cap}e0, 1e0) AS hate,
    CASE WHEN len(toks) = 0 THEN 0e0
         ELSE least(CAST(len(vh) + len(hh) AS DOUBLE) / len(toks) / {model.density_cap}e0, 1e0) END AS keyword_density,
    least(ic / {model.lexicon_cap}e0, 1e0) AS intensifiers,
    CASE WHEN len(th) > 0 THEN 1e0 ELSE 0e0 END AS threat,
    CASE WHEN n_words = 0 THEN 0e0
         ELSE least(CAST(n_caps AS DOUBLE) / n_words / {model.caps_cap}e0, 1e0) END AS all_caps
  FROM {name}_2),
{name}_4 AS (SELECT *, greatest(0e0, least({w['violent']}e0 * violent + {w['hate']}e0 * hate
    + {w['keyword_density']}e0 * keyword_density + {w['threat']}e0 * threat
    + {w['all_caps']}e0 * all_caps + {w['intensifiers']}e0 * intensifiers, 1e0)) AS risk_score
  FROM {name}_3),
{name} AS (SELECT *, {label('risk_score', model.high, model.medium)} AS risk_label FROM {name}_4)"""


def label(score: str, high: float = 0.8, medium: float = 0.5) -> str:
    return (
        f"CASE WHEN {score} >= {high}e0 THEN 'high' WHEN {score} >= {medium}e0 THEN 'medium' "
        "ELSE 'low' END"
    )


def post_explanation(language: str = "'unknown'") -> str:
    def terms(name: str, column: str) -> str:
        shown = f"array_to_string(list_sort(list_distinct({column}))[1:5], ', ')"
        return (
            f"CASE WHEN len({column}) > 0 THEN "
            f"'{name}=' || len({column}) || ' (' || {shown} || ')' END"
        )

    return f"""concat_ws('; ', 'language=' || {language},
    'score=' || printf('%.2f', risk_score) || ' (' || risk_label || ')',
    {terms('violent', 'vh')}, {terms('hate', 'hh')},
    CASE WHEN ic > 0 THEN 'intensifiers=' || ic END,
    CASE WHEN len(th) > 0 THEN 'threat=(' || array_to_string(th[1:3], '; ') || ')' END,
    CASE WHEN all_caps > 0 THEN 'allcaps=' || printf('%.2f', all_caps) END,
    CASE WHEN keyword_density > 0 THEN 'density=' || printf('%.2f', keyword_density) END,
    CASE WHEN len(vh) = 0 AND len(hh) = 0 AND len(th) = 0 THEN 'no explicit harmful keywords' END)"""


def stats(score: str = "score", high: float = 0.8) -> str:
    return f"""max({score}) AS max_post_score,
    CAST(sum(CAST({score} AS DECIMAL(28,12))) AS DOUBLE) / count({score}) AS average_score,
    count(*) FILTER ({score} >= {high}e0) AS count_high_posts, count({score}) AS total_posts"""


USER_SCORE = "greatest(max_post_score, average_score + 2e-1 * ln(1 + count_high_posts))"


def user_risk(users: str, own: str, fallback: str | None, name: str = "risk") -> str:
    """CTEs giving the user risk of ``users`` from (username, score) tables."""
    posts = (
        f"SELECT username, {stats()} FROM {fallback} GROUP BY username"
        if fallback
        else f"SELECT username, {stats()} FROM {own} WHERE false GROUP BY username"
    )
    return f"""
{name}_own AS (SELECT username, {stats()} FROM {own} GROUP BY username),
{name}_posts AS ({posts}),
{name}_all AS (
  SELECT *, false AS from_posts FROM {name}_own
  UNION ALL
  SELECT *, true FROM {name}_posts WHERE username NOT IN (SELECT username FROM {name}_own)),
{name}_1 AS (SELECT u.username, coalesce(max_post_score, 0e0) AS max_post_score,
    coalesce(average_score, 0e0) AS average_score, coalesce(count_high_posts, 0) AS count_high_posts,
    coalesce(total_posts, 0) AS total_posts, from_posts
  FROM {users} u LEFT JOIN {name}_all a ON u.username = a.username),
{name}_2 AS (SELECT *, CASE WHEN total_posts > 0 THEN {USER_SCORE} ELSE 0e0 END AS score FROM {name}_1),
{name}_3 AS (SELECT *, {label('score')} AS label FROM {name}_2),
{name} AS (SELECT username, score, label, max_post_score, average_score, count_high_posts, total_posts,
    CASE WHEN total_posts = 0 THEN 'No historical activity or scored posts found for this user; user_score set to 0.00 (low).'
    ELSE concat_ws('; ', count_high_posts || ' high-risk posts out of ' || total_posts || ' items',
      'max_post_score=' || printf('%.2f', max_post_score),
      'user_score=' || printf('%.2f', score) || ' (' || label || ')',
      CASE WHEN from_posts THEN 'no user history found; score derived from current scored posts only.'
           ELSE 'derived from historical activity only (last window).' END,
      CASE WHEN total_posts < 5 THEN 'low-confidence estimate (only ' || total_posts || ' items available).' END)
    END AS explanation FROM {name}_3)"""


USER_COLUMNS = (
    "username, score, label, max_post_score, average_score, count_high_posts, total_posts, explanation"
)


def chained(source: str, key: str, per_page: int, name: str = "paged") -> str:
    """CTE of the rows of ``source`` on the pages that ``tables.chained`` makes of them.

    ``page`` counts from 0, ``number`` is the listing's.
    """
    return f"""{name} AS (
  SELECT *, (row_number() OVER (PARTITION BY {key} ORDER BY created_utc DESC, id) - 1) // {per_page} AS page,
    CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) % 60 AS number
  FROM {source})"""


# Rows that a crawl gets: where the second page never comes, those of the first.
REACHED = "(number % 5 <> 2 OR page = 0)"
