"""Canonical URLs and link safety as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomsift.functions.text import bound

# Query parameters that only track.
TRACKING = (
    "fbclid gclid dclid yclid twclid igshid msclkid gbraid wbraid ref referrer reference source from spm scm mc_id mc_eid wt.mc_id mkt_tok vero_id "
    "hsa_cam ncid mbid cmpid tab pk_campaign pk_kwd trk scid cid _hsenc _hsmi"
).split()
TRACKING_PREFIXES = "utm_ pk_ hsa_ mkt_ igsh vero_ mc_ wt.".split()


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def _encoded(path: Column) -> Column:
    """A path as browsers send it: what may not stand in one is percent-encoded."""
    odd = "[^!-~]|[\"<>`{}]"
    each = lambda c: F.when(c.rlike(odd), F.replace(F.url_encode(c), F.lit("+"), F.lit("%20"))).otherwise(c)
    return F.when(path.rlike(odd), F.array_join(F.transform(F.regexp_extract_all(path, F.lit("(?s)."), F.lit(0)), each), "")).otherwise(path)


def canonical_url(raw: Column) -> Column:
    """http(s) only: scheme, lower-case host without www. and port, path without trailing slashes, the parameters that
    do not track, sorted. An empty string for anything else. Read by patterns, as leniently as browsers do."""
    return bound(_trimmed(raw), _canonical)


def _trimmed(raw: Column) -> Column:
    return F.regexp_replace(F.coalesce(raw, F.lit("")), "^[\\x00-\\x20]+|[\\x00-\\x20]+\\z|[\\t\\n\\r]", "")


def _scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def _found(url: Column, k: int) -> Column:
    """Authority, path or query of a trimmed url."""
    return F.regexp_extract(url, "^[A-Za-z]+:[/\\\\]*([^/\\\\?#]*)([^?#]*)(?:\\?([^#]*))?", k)


def _host(url: Column) -> Column:
    """The host of a trimmed url, an empty string if it can be none."""
    host = F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(_found(url, 1), "^.*@", ""), ":[0-9]*$", "")), "^www\\.", "")
    return bound(host, lambda h: F.when(h.rlike("[\\x00-\\x20<>^|%\"`{}]|^$"), F.lit("")).otherwise(h))


def _canonical(url: Column) -> Column:
    scheme, host, found = _scheme(url), _host(url), lambda k: _found(url, k)
    path = bound(F.replace(found(2), F.lit("\\"), F.lit("/")), _encoded)
    bare = bound(F.regexp_replace(path, "/+$", ""), lambda b: F.when(b == "", F.lit("/")).otherwise(b))
    decode = lambda c: F.coalesce(F.try_url_decode(c), c)
    pairs = F.transform(
        F.filter(F.split(F.coalesce(found(3), F.lit("")), "&"), lambda p: p != ""),
        lambda p: F.struct(F.lower(decode(F.substring_index(p, "=", 1))).alias("k"), decode(F.when(F.contains(p, F.lit("=")), F.regexp_replace(p, "^[^=]*=", "")).otherwise(F.lit(""))).alias("v")),
    )
    tracks = lambda k: k.isin(TRACKING) | k.rlike("^(" + "|".join(p.replace(".", "\\.") for p in TRACKING_PREFIXES) + ")")
    kept = F.array_sort(F.transform(F.filter(pairs, lambda p: ~tracks(p["k"])), lambda p: F.concat(p["k"], F.lit("="), p["v"])))
    # Urls without a query, most of them, are not split for it.
    query = F.when(F.contains(url, F.lit("?")), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))).otherwise(F.lit(""))
    whole = lambda s, h: F.when(s.isin("http", "https") & (F.coalesce(h, F.lit("")) != ""), F.concat(s, F.lit("://"), h, bare, query)).otherwise(F.lit(""))
    return bound(scheme, lambda s: bound(host, lambda h: whole(s, h)))


def same_document(a: Column, b: Column) -> Column:
    return (canonical_url(a) != "") & (canonical_url(a) == canonical_url(b))


def _private_v4(host: Column) -> Column:
    octets = F.transform(F.split(host, "\\."), lambda o: o.try_cast("int"))
    a, b = F.get(octets, 0), F.get(octets, 1)
    return (
        a.isin(0, 10, 127) | (a >= 224) | ((a == 169) & (b == 254)) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168)) | ((a == 100) & b.between(64, 127)) | ((a == 198) & b.isin(18, 19))
    )


def is_public_origin(url: Column) -> Column:
    """No user info, and a host that is not local or in a private network; IPv6 literals are refused unless global."""
    host = F.lower(F.coalesce(part(url, "HOST"), F.lit("")))
    v6 = F.regexp_extract(host, "^\\[(.*)\\]$", 1)
    local6 = v6.rlike("^(::1?|f[cd].*|fe[89ab].*|ff.*|::ffff:.*|64:ff9b:.*|2001:db8:.*)$")
    local = host.isin("localhost", "") | host.rlike("\\.(localhost|local|internal)$") | ~host.rlike("[.:]")
    v4 = host.rlike("^[0-9]+(\\.[0-9]+){3}$")
    safe = F.when(v6 != "", ~local6).when(v4, ~_private_v4(host)).otherwise(~local)
    return F.coalesce(part(url, "USERINFO").isNull() & safe, F.lit(False))


def is_public_https(url: Column) -> Column:
    """https and a public origin."""
    return F.coalesce((F.lower(part(url, "PROTOCOL")) == "https") & is_public_origin(url), F.lit(False))


def is_safe_link(url: Column) -> Column:
    """A link a reader may follow: http or https with a host, read as leniently as browsers do."""
    return bound(_trimmed(url), lambda u: _scheme(u).isin("http", "https") & (_host(u) != ""))


def since_days(template: str, now_ms: int) -> str:
    """A source address with {{since_days:N}} filled in by the UTC date N days before now."""
    import datetime
    import re

    day = lambda n: (datetime.datetime.fromtimestamp(now_ms / 1000, datetime.timezone.utc) - datetime.timedelta(days=n)).strftime("%Y-%m-%d")
    return re.sub(r"\{\{since_days:(\d+)\}\}", lambda m: day(int(m[1])), template)
