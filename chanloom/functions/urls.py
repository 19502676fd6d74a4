"""URL column functions.

Scheme and host follow ``urllib.parse`` (scheme = letters/digits/``+-.``
before the first colon, host = netloc after the last ``@``, without port or
brackets, lower case).  They are regular expressions, so they never raise on
malformed input (``try_parse_url`` rejects hosts the original accepts).
Relative-reference resolution follows RFC 3986 section 5.2 as the standard
library applies it: merge, remove dot segments, drop empty components.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME_RE = "^([A-Za-z][A-Za-z0-9+.\\-]*):"


def _clean(col: Column) -> Column:
    # urlsplit drops tab/CR/LF anywhere and C0 controls / spaces in front.
    c = F.regexp_replace(F.coalesce(col, F.lit("")), "[\\t\\r\\n]", "")
    return F.regexp_replace(c, "^[\\x00-\\x20]+", "")


def url_scheme(col: Column | str) -> Column:
    return F.lower(F.regexp_extract(_clean(_col(col)), _SCHEME_RE, 1))


def is_https(col: Column | str) -> Column:
    """``url_scheme(col) == "https"``; the patterns only run for URLs that
    start with neither usual scheme."""
    c = _col(col)
    return F.when(c.startswith("https:"), True).when(c.startswith("http:"), False).otherwise(url_scheme(c) == "https")


# http or https scheme in one pattern: leading C0 controls / spaces are
# skipped and tab / CR / LF may appear anywhere (urlsplit removes them).
_HTTP_RE = "^[\\x00-\\x20]*(?i:h[\\t\\r\\n]*t[\\t\\r\\n]*t[\\t\\r\\n]*p[\\t\\r\\n]*(?:s[\\t\\r\\n]*)?):"


def is_http_url(col: Column | str) -> Column:
    return F.coalesce(_col(col), F.lit("")).rlike(_HTTP_RE)


# Host info (netloc after the last '@') in one pattern, for URLs without
# tab / CR / LF.
_HOSTINFO_RE = "^[\\x00-\\x20]*(?:[A-Za-z][A-Za-z0-9+.\\-]*:)?//(?:[^/?#]*@)?([^/?#@]*)"


def url_host(col: Column | str) -> Column:
    """Lower-cased host name ('' when there is none)."""
    c = F.coalesce(_col(col), F.lit(""))
    rest = F.regexp_replace(_clean(c), _SCHEME_RE, "")
    netloc = F.regexp_extract(rest, "^//([^/?#]*)", 1)
    exact = F.regexp_extract(netloc, "([^@]*)$", 1)
    hostinfo = F.when(c.rlike("[\\t\\r\\n]"), exact).otherwise(F.regexp_extract(c, _HOSTINFO_RE, 1))
    bracketed = F.regexp_extract(hostinfo, "\\[([^\\]]*)", 1)
    plain = F.regexp_extract(hostinfo, "^([^:]*)", 1)
    host = F.when(hostinfo.contains("["), bracketed).otherwise(plain)
    return F.lower(host)


# fixed values: schemes that relative references apply to
HIERARCHICAL = ["", "file", "ftp", "gopher", "http", "https", "imap", "mms", "nntp", "prospero", "rtsp", "rtsps", "rtspu",
                "sftp", "shttp", "svn", "svn+ssh", "wais", "ws", "wss"]


# Components of a cleaned reference (RFC 3986 appendix B, the parameters of
# the last segment apart): scheme, authority, path, parameters, query, fragment.
_PARTS = ("scheme", "netloc", "path", "params", "query", "fragment")
_PARTS_RE = ("(?s)^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(?://([^/?#]*))?((?:[^/?#]*/)*+[^/;?#]*)(?:;([^/?#]*))?"
             "(?:\\?([^#]*))?(?:#(.*))?$")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _split(c: Column) -> Column:
    fields = [F.regexp_extract(c, _PARTS_RE, i + 1).alias(name) for i, name in enumerate(_PARTS)]
    return F.struct(F.lower(fields[0]).alias("scheme"), *fields[1:])


def _tagged(mark: str, value: Column) -> Column:
    return F.when(value == "", "").otherwise(F.concat(F.lit(mark), value))


def _unsplit(scheme: Column, netloc: Column, path: Column, params: Column, query: Column, fragment: Column) -> Column:
    """The reference of its components; empty ones are dropped.  A path that
    could be taken for an authority gets an empty one in front."""
    def rooted(whole):
        bare = whole.startswith("//") | ((scheme != "") & ((whole == "") | whole.startswith("/")))
        lead = F.when((whole == "") | whole.startswith("/"), "").otherwise("/")
        return F.when(netloc != "", F.concat(F.lit("//"), netloc, lead, whole)).when(bare, F.concat(F.lit("//"), whole)).otherwise(whole)

    return F.concat(F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":"))),
                    _let(F.concat(path, _tagged(";", params)), rooted), _tagged("?", query), _tagged("#", fragment))


def _merged_path(base: Column, ref: Column) -> Column:
    """Path of ``ref`` relative to the directory of ``base``, without dot
    segments; a merge also drops empty inner segments."""
    folder = _let(F.split(base, "/"), lambda own: F.when(F.element_at(own, -1) == "", own).otherwise(F.slice(own, 1, F.size(own) - 1)))

    def compact(p):
        inner = F.filter(F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0))), lambda x: x != "")
        return F.when(F.size(p) < 2, p).otherwise(F.concat(F.slice(p, 1, 1), inner, F.slice(p, F.size(p), 1)))

    def walk(p):
        out = F.aggregate(p, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
            x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
        return F.concat(out, F.when(F.element_at(p, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))

    merged = _let(F.concat(folder, F.split(ref, "/")), compact)
    parts = F.when(ref.startswith("/"), F.split(ref, "/")).otherwise(merged)
    joined = _let(parts, lambda p: F.array_join(walk(p), "/"))
    return _let(joined, lambda j: F.when(j == "", "/").otherwise(j))


def url_resolve(base: Column | str, ref: Column | str) -> Column:
    """The reference resolved against the base; NULL when either side is NULL
    or the reference is ''."""
    b, r = _col(base), _col(ref)

    def resolve(u):
        bu, ru = u["b"], u["r"]
        own = ru["scheme"] == ""
        foreign = (~own & (ru["scheme"] != bu["scheme"])) | ~F.when(own, bu["scheme"]).otherwise(ru["scheme"]).isin(HIERARCHICAL)
        bare = (ru["path"] == "") & (ru["params"] == "")
        rest = (ru["query"], ru["fragment"])
        query = F.when(ru["query"] == "", bu["query"]).otherwise(ru["query"])
        return (F.when(b == "", r).when(foreign, r)
                .when(ru["netloc"] != "", _unsplit(bu["scheme"], ru["netloc"], ru["path"], ru["params"], *rest))
                .when(bare, _unsplit(bu["scheme"], bu["netloc"], bu["path"], bu["params"], query, ru["fragment"]))
                .otherwise(_unsplit(bu["scheme"], bu["netloc"], _merged_path(bu["path"], ru["path"]), ru["params"], *rest)))

    return F.when(b.isNotNull() & (r != ""), _let(F.struct(_split(_clean(b)).alias("b"), _split(_clean(r)).alias("r")), resolve))


def _col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
