"""Not-modified revisits of a web archive, resolved to full responses.

A *revisit* record has no body: it says that a page was fetched again and not
changed. It is resolved by an as-of join: the latest full response of the same
canonical URL that is strictly earlier (of several at one instant, the one with
the greatest record id). Then the validators that the revisit has are compared
with that response (payload digest; entity tag, weakly; last-modified), and the
revisit's permitted headers replace the response's.

The as-of join has no window over a whole URL. Records fall into chunks of time
by URL: each chunk's latest response is a partial aggregate; a window over
chunks (one row each) carries it forward; a window inside a chunk looks at that
chunk's records alone. So a URL with very many records is many small groups.

Results, by ``outcome``: ``resolved``; ``mismatch`` (a validator differs);
``unvalidated`` (the revisit has none that the response has too);
``no_response`` (none earlier). Only resolved ones get merged headers and the
response's digest. Records with a null URL or time take no part as responses
and are ``no_response`` as revisits. Header names are lower-cased; of several
that then clash the first in the map counts; null headers are none. Repeated
rows give a row each; other columns are left out; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Seconds in a chunk.
CHUNK = 86_400
#: Headers of a revisit that never replace the response's: they speak of the message without a
#: body, or of one connection.
NOT_PERMITTED = ("connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
                 "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade")
ENTRIES = "array<struct<key:string,value:string>>"


def canonical_url(url: str) -> str:
    """SQL text: scheme and host in lower case, without the scheme's own port, fragment, ``utm_``
    and empty parameters; parameters sorted; an empty path is ``/``. Others than ``scheme://`` stay."""
    part = lambda i: f"regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)[?]?([^#]*)', {i})"
    host = (f"regexp_replace(concat(lower({part(1)}), '://', lower({part(2)})), "
            "'^(http://[^/]*):80$|^(https://[^/]*):443$', '$1$2')")
    query = f"array_join(array_sort(filter(split({part(4)}, '&'), x -> x <> '' and x not like 'utm\\\\_%')), '&')"
    return (f"case when {part(1)} = '' then {url} else concat({host}, if({part(3)} = '', '/', {part(3)}), "
            f"if({query} = '', '', concat('?', {query}))) end")


def _entries(headers: str) -> str:
    """SQL text: the headers as entries with lower-case names, sorted."""
    return (f"array_sort(transform(array_distinct(transform(map_keys({headers}), k -> lower(k))), k -> struct(k as key, "
            f"filter(map_entries({headers}), e -> lower(e.key) = k)[0].value as value)))")


def _header(entries: str, name: str) -> str:
    return f"get(filter({entries}, e -> e.key = '{name}'), 0).value"


def resolve(records: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Revisits of ``records`` (``record_id long, kind string, url string, at long, status int,
    headers map<string,string>, digest string``; kind ``response`` or ``revisit``; a response is full
    with status 200): ``record_id, url, base_id, base_at, outcome, headers, digest``."""
    rows = records.select(
        F.col("record_id").cast("long").alias("record_id"), "kind", F.expr(canonical_url("url")).alias("url"),
        F.col("at").cast("long").alias("at"), "status",
        F.coalesce(F.expr(_entries("headers")), F.expr(f"cast(array() as {ENTRIES})")).alias("headers"), "digest")
    rows = rows.withColumn("chunk", F.expr(f"floor(at / {chunk})"))
    usable = "kind = 'response' and status = 200 and url is not null and at is not null"
    rows = rows.where(f"kind = 'revisit' or ({usable})").withColumn(
        "full", F.expr("case when kind = 'response' then struct(at, record_id, digest, headers) end"))
    latest = rows.groupBy("url", "chunk").agg(F.max("full").alias("full"))
    carried = latest.selectExpr(
        "url", "chunk", "max(full) over (partition by url order by chunk rows between unbounded preceding and "
        "1 preceding) as before")
    inside = rows.selectExpr(
        "*", "max(full) over (partition by url, chunk order by at range between unbounded preceding and 1 preceding) "
        "as here").where("kind = 'revisit'")
    found = inside.join(carried, ["url", "chunk"], "left").withColumn(
        "base", F.expr("case when at is not null then coalesce(here, before) end"))
    pairs = [("digest", "base.digest"),
             (f"regexp_replace({_header('headers', 'etag')}, '^W/', '')",
              f"regexp_replace({_header('base.headers', 'etag')}, '^W/', '')"),
             (_header("headers", "last-modified"), _header("base.headers", "last-modified"))]
    differs = " or ".join(f"coalesce({a} <> {b}, false)" for a, b in pairs)
    agrees = " or ".join(f"coalesce({a} = {b}, false)" for a, b in pairs)
    denied = ", ".join(f"'{h}'" for h in NOT_PERMITTED)
    permitted = f"filter(headers, e -> e.key not in ({denied}))"
    merged = (f"array_sort(concat(filter(base.headers, b -> not exists({permitted}, e -> e.key = b.key)), {permitted}))")
    return found.selectExpr(
        "record_id", "url", "base.record_id as base_id", "base.at as base_at",
        f"case when base is null then 'no_response' when {differs} then 'mismatch' when {agrees} then 'resolved' "
        "else 'unvalidated' end as outcome", f"{merged} as merged", "base.digest as base_digest").selectExpr(
        "record_id", "url", "base_id", "base_at", "outcome",
        "case when outcome = 'resolved' then map_from_entries(merged) end as headers",
        "case when outcome = 'resolved' then base_digest end as digest")


def records_of_pages(pages: DataFrame) -> DataFrame:
    """An archive made of the page table: each page is fetched (a response), asked for again a day later
    (a revisit, by a URL with a fragment and a tracking parameter); some are fetched anew in between, with
    another body; some revisits come before any response, some carry another entity tag or no digest."""
    p = pages.selectExpr("page_id", "url", "md5(html) as md5", "length(html) as n", "page_id * 60 as at")
    mark = "case when instr(url, '#') > 0 then url else concat(url, if(instr(url, '?') > 0, '&', '?'), 'utm_medium=feed#x') end"

    def records(where: str, shift: int, kind: str, url: str, at: str, status: int, tag: str, more: str, digest: str):
        return p.where(where).selectExpr(
            f"page_id * 4 + {shift} as record_id", f"'{kind}' as kind", f"{url} as url", f"{at} as at", f"{status} as status",
            f"map('ETag', {tag}, {more}) as headers", f"{digest} as digest")

    body = "'Content-Type', 'text/html', 'Content-Length', cast(n as string), 'X-Cache', 'miss'"
    none = "'Content-Length', '0', 'Date', concat('day ', cast(floor(at / 86400) + 1 as string)), 'X-Cache', 'hit'"
    return (records("true", 0, "response", "url", "at", 200, "concat('\"', md5, '\"')", body, "md5")
            .union(records("page_id % 4 = 0", 2, "response", "url", "at + 43200", 200, "concat('\"', reverse(md5), '\"')",
                           body, "reverse(md5)"))
            .union(records("true", 1, "revisit", mark, "at + 86400", 304,
                           "concat('W/\"', if(page_id % 5 = 0, 'changed', if(page_id % 4 = 0, reverse(md5), md5)), '\"')",
                           none, "case when page_id % 3 <> 0 then if(page_id % 4 = 0, reverse(md5), md5) end"))
            .union(records("page_id % 7 = 0", 3, "revisit", mark, "at - 30", 304, "concat('\"', md5, '\"')", none, "md5")))


def digest(resolved: DataFrame) -> DataFrame:
    """Headers as one sorted text."""
    return resolved.withColumn("headers", F.expr(
        "array_join(array_sort(transform(map_entries(headers), e -> concat(e.key, '=', e.value))), '; ')"))
