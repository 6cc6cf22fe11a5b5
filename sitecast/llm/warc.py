"""WARC records: not-modified revisits resolved to the response they stand for.

A revisit with the server-not-modified profile holds a 304 answer and no content.
It stands for the latest full response captured before it under the same canonical
URL.  That as-of join runs over chunks of the captures in URL and time order, so a
URL with any share of all captures is split.  The validators of both must agree;
then the stored headers are updated by those that a 304 answer may carry.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecast.operators.ordering import prefixed
from sitecast.session import materialize

# The headers a 304 answer updates, and the revisit profile.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
PROFILE = "server-not-modified"
_EMPTY_LINE = re.compile(r"\r?\n\r?\n")
#: Query parameters that do not name another resource.
TRACKING = r"(?i)^(utm_[a-z]+|ref|sessionid|phpsessid|jsessionid|fbclid|gclid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host and path of a URL in one spelling; null for anything but an absolute http URL.

    Scheme, ``www.``, default port, user, fragment, tracking parameters and a slash
    at the end are dropped; the host is in lower case, parameters are sorted.
    """
    url = F.trim(url)
    bare = F.regexp_replace(url, "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"(?i)^https?://(?:[^/?@]*@)?(?:www\d*\.)?([^/?:]+)", 1))
    port = F.regexp_extract(bare, r"(?i)^https?://[^/?]*?:(\d+)(?:[/?]|$)", 1)
    path = F.regexp_replace(F.regexp_extract(bare, r"(?i)^https?://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike(TRACKING))), "&")
    out = F.concat(
        host,
        F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)),
        path,
        F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""),
    )
    return F.when(host != "", out)


def _fields(block: str) -> list[dict[str, str]]:
    """Header lines of a block by name in lower case; the last of a name counts."""
    found = {}
    for line in block.splitlines():
        name, colon, value = line.partition(":")
        if colon and name.strip():
            found[name.strip().lower()] = value.strip()
    return [{"name": n, "value": found[n]} for n in sorted(found)]


def _value(fields: Column, name: str) -> Column:
    return F.get(F.filter(fields, lambda x: x["name"] == name), F.lit(0))["value"]


def parse_records(raw: DataFrame, record: str = "record") -> DataFrame:
    """``(record_id, type, uri, canonical, date, profile, http_status, headers, body)`` of raw WARC records.

    A record is a WARC header block, an empty line, an HTTP header block, an empty
    line and the body.  A null or malformed record gives nulls, not an error.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.list_(pa.struct([("name", pa.string()), ("value", pa.string())]))
        for batch in batches:
            # The first empty line ends the record's header, the second that of the answer.
            parts = [(_EMPTY_LINE.split(v.as_py() or "", 2) + ["", ""])[:3] for v in batch.column(0)]
            answers = [h.partition("\n") if h.startswith("HTTP/") else ("", "", h) for _, h, _ in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_fields(w) for w, _, _ in parts], fields), pa.array([first for first, _, _ in answers], pa.string()),
                    pa.array([_fields(rest) for _, _, rest in answers], fields), pa.array([body for _, _, body in parts], pa.string()),
                ],
                names=["w", "answer", "headers", "body"],
            )

    fields = "array<struct<name: string, value: string>>"
    rows = raw.select(record).mapInArrow(cut, f"w {fields}, answer string, headers {fields}, body string")
    rows = rows.withColumn("uri", _value(F.col("w"), "warc-target-uri"))
    return rows.select(
        _value(F.col("w"), "warc-record-id").alias("record_id"),
        F.lower(_value(F.col("w"), "warc-type")).alias("type"),
        "uri",
        canonical_url(F.col("uri")).alias("canonical"),
        F.try_to_timestamp(_value(F.col("w"), "warc-date"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("date"),
        _value(F.col("w"), "warc-profile").alias("profile"),
        F.regexp_extract("answer", r"^HTTP/\S+ (\d{3})", 1).try_cast("int").alias("http_status"),
        "headers",
        "body",
    )


def _etag(value: Column) -> Column:
    """An entity tag for the weak comparison."""
    return F.regexp_replace(F.trim(value), r"^[wW]/", "")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """One row for each not-modified revisit, with the response it stands for.

    ``records`` has the columns of ``parse_records``.  ``outcome`` is ``resolved``,
    ``unvalidated`` (resolved, but no validator is in both), ``etag_mismatch`` or
    ``modified_mismatch`` (the latest earlier response is another version),
    ``no_response`` (none is earlier) or ``no_url`` (no canonical URL or date).
    ``target_id``, ``digest`` (SHA-256 of the body) and the merged ``headers`` are
    null unless resolved.  A response of the same second is not earlier; of
    responses of one second the greatest record id counts.  Only 2xx responses but
    206 are full.  Repeated revisits give a row each; an empty table gives none.
    """
    status = F.col("http_status")
    full = (F.col("type") == "response") & status.between(200, 299) & (status != 206)
    revisit = (F.col("type") == "revisit") & F.col("profile").contains(PROFILE)
    narrow = records.select(
        "record_id", "uri", "canonical", "date", "headers",
        F.coalesce(full, F.lit(False)).alias("full"),
        F.coalesce(revisit, F.lit(False)).alias("revisit"),
        F.sha2("body", 256).alias("digest"),
    )
    # Stored before it is sorted: a range sort reads its input twice.
    narrow = materialize(narrow).where("full or revisit")
    placed = F.col("canonical").isNotNull() & F.col("date").isNotNull()
    stored = F.when(F.col("full") & placed, F.struct("date", "record_id", "headers", "digest"))
    met = prefixed(narrow, ["canonical"], [F.col("date"), F.col("full"), F.col("record_id"), F.col("uri")], {"last": ("max", stored, "before")})
    met = met.where("revisit")
    last = F.when(placed, F.col("last"))
    mine, theirs = F.col("headers"), F.col("_last.headers")
    tags = _etag(_value(mine, "etag")), _etag(_value(theirs, "etag"))
    times = _value(mine, "last-modified"), _value(theirs, "last-modified")
    outcome = (
        F.when(~placed, "no_url")
        .when(F.col("_last").isNull(), "no_response")
        .when(tags[0].isNotNull() & tags[1].isNotNull(), F.when(tags[0] == tags[1], "resolved").otherwise("etag_mismatch"))
        .when(times[0].isNotNull() & times[1].isNotNull(), F.when(times[0] == times[1], "resolved").otherwise("modified_mismatch"))
        .otherwise("unvalidated")
    )
    fresh = F.filter(mine, lambda x: x["name"].isin(*PERMITTED))
    names = F.transform(fresh, lambda x: x["name"])
    merged = F.array_sort(F.concat(F.filter(theirs, lambda x: ~F.array_contains(names, x["name"])), fresh))
    done = F.col("outcome").isin("resolved", "unvalidated")
    return met.withColumn("_last", last).withColumn("outcome", outcome).select(
        "record_id", "uri", "canonical", "date", "outcome",
        F.when(done, F.col("_last.record_id")).alias("target_id"),
        F.when(done, F.col("_last.digest")).alias("digest"),
        F.when(done, F.array_join(F.transform(merged, lambda x: F.concat(x["name"], F.lit(": "), x["value"])), "\n")).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Raw records of a crawl of ``pages``: one response each and three later or earlier revisits.

    Times, spellings of the URL and validators follow from the page's id, so that
    every outcome occurs; a page without a URL has records without one.
    """
    n = F.coalesce("page_id", F.lit(0)).cast("long")
    first = F.lit(1_704_067_200) + F.pmod(n * 7919, F.lit(2_592_000))
    stamp = lambda s: F.concat(F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    modified = F.concat(F.lit("day "), F.pmod(n, F.lit(28)))
    rows = pages.select("url", "html", n.alias("n"), first.alias("t"), tag.alias("tag"), modified.alias("mod"), F.explode(F.array(*[F.lit(k) for k in range(4)])).alias("k"))
    n, k, url = F.col("n"), F.col("k"), F.col("url")
    when = F.when(k == 0, F.col("t")).otherwise(F.col("t") + k * 3600 * (1 + F.pmod(n, F.lit(5))) - F.when(F.pmod(n, F.lit(4)) == 3, 2 * 3600).otherwise(0))
    host = F.regexp_extract(url, r"^https?://([^/?#]*)", 1)
    spelled = (
        F.when(k < 2, url)
        .when(k == 2, F.concat(F.lit("HTTP://"), F.upper(host), F.lit(":80"), F.regexp_replace(url, r"^https?://[^/?#]*", ""), F.lit("#part")))
        .otherwise(F.concat(F.regexp_replace(url, "#.*$", ""), F.when(F.contains(url, F.lit("?")), "&").otherwise("?"), F.lit("utm_campaign=x")))
    )
    shown = F.when(k == 2, F.concat(F.lit("W/"), F.col("tag"))).when((k == 3) & (F.pmod(n, F.lit(11)) == 0), F.lit('"other"')).otherwise(F.col("tag"))
    head = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.0"),
        F.concat(F.lit("WARC-Type: "), F.when(k == 0, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), n, F.lit(":"), k, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), spelled),
        F.concat(F.lit("WARC-Date: "), stamp(when)),
        F.when(k > 0, "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/server-not-modified"),
    )
    answer = F.concat_ws(
        "\r\n",
        F.when(k > 0, "HTTP/1.1 304 Not Modified").when(F.pmod(n, F.lit(13)) == 5, "HTTP/1.1 206 Partial Content").otherwise("HTTP/1.1 200 OK"),
        F.concat(F.lit("Date: "), stamp(when)),
        F.when(F.pmod(n, F.lit(7)) != 0, F.concat(F.lit("ETag: "), shown)),
        F.when(F.pmod(n, F.lit(3)) != 0, F.concat(F.lit("Last-Modified: "), F.when((k == 1) & (F.pmod(n, F.lit(14)) == 0), "day 0x").otherwise(F.col("mod")))),
        F.concat(F.lit("Cache-Control: max-age="), k * 60),
        F.when(k == 0, F.concat(F.lit("Content-Length: "), F.octet_length(F.coalesce("html", F.lit(""))))).otherwise("Content-Length: 0"),
        F.when(k == 3, "Set-Cookie: s=1"),
    )
    body = F.when(k == 0, F.coalesce("html", F.lit(""))).otherwise("")
    return rows.select(F.concat(head, F.lit("\r\n\r\n"), answer, F.lit("\r\n\r\n"), body).alias("record"))
