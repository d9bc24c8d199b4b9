"""URL reference resolution (RFC 3986) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.let import bind

# RFC 3986, appendix B.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"

# Characters outside this set make a path be percent-encoded as a whole.
_PATH_SAFE = r"[^A-Za-z0-9\-_.~!$&'()*+,;=:@/\[\]%]"

# Reserved characters that stay plain in an encoded path or fragment.
_KEEP_PLAIN = {
    "%24": "$", "%26": "&", "%2B": "+", "%2C": ",", "%2F": "/", "%3A": ":",
    "%3B": ";", "%3D": "=", "%40": "@", "%7E": "~",
}
_KEEP_PLAIN_FRAGMENT = {"%21": "!", "%28": "(", "%29": ")", "%2A": "*", "%3F": "?"}


def _url_parts(url: Column) -> Column:
    """Struct of scheme, authority, path, query, fragment; absent parts are empty."""
    names = ["scheme", "authority", "path", "query", "fragment"]
    return F.struct(
        *[F.regexp_extract(url, _PARTS, i + 1).alias(n) for i, n in enumerate(names)],
        F.contains(F.substring_index(url, "#", 1), F.lit("?")).alias("has_query"),
    )


def _reencode(text: Column, keep: dict[str, str]) -> Column:
    plain = F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    out = F.url_encode(plain)
    for found, wanted in {"+": "%20", "*": "%2A", **keep}.items():
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def _encoded(text: Column, keep: dict[str, str]) -> Column:
    return bind(text, lambda t: F.when(~t.rlike(_PATH_SAFE), t).otherwise(_reencode(t, keep)))


def _encoded_fragment(text: Column) -> Column:
    return _encoded(text, _KEEP_PLAIN | _KEEP_PLAIN_FRAGMENT)


def _rooted(path: Column) -> Column:
    return F.when((path == "") | path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


def _without_dots(path: Column) -> Column:
    kept = F.aggregate(
        F.split(path, "/", -1),
        F.array().cast("array<string>"),
        lambda acc, e: F.when(e == ".", acc)
        .when(e == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(e))),
    )
    joined = F.concat(
        F.array_join(kept, "/"), F.when(path.rlike(r"(?:^|/)\.\.?$"), "/").otherwise("")
    )
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), joined).otherwise(path)


def base_url(url: Column) -> Column:
    """What resolving against `url` needs, computed once per page. `origin` leaves out user info."""

    def parts(u: Column) -> Column:
        scheme = F.lower(u["scheme"])
        host = F.regexp_replace(u["authority"], r"^.*@", "")
        return F.struct(
            scheme.alias("scheme"),
            u["authority"].alias("authority"),
            _encoded(u["path"], _KEEP_PLAIN).alias("path"),
            F.when(u["has_query"], F.concat(F.lit("?"), u["query"])).otherwise("").alias("query"),
            _encoded_fragment(u["fragment"]).alias("fragment"),
            F.concat(scheme, F.lit("://"), host).alias("origin"),
        )

    return bind(_url_parts(url), parts)


def resolve_url(base: Column, href: Column) -> Column:
    """Resolve `href` against a `base_url`; NULL when it is not a valid URL.

    Opaque references (`mailto:` and the like) give NULL too: they never name a page.
    """
    return bind(_url_parts(href), lambda ref: _resolve(base, href, ref))


def _resolve(base: Column, href: Column, ref: Column) -> Column:
    has_scheme = ref["scheme"] != ""
    has_authority = href.rlike(r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//")
    absolute = has_scheme | has_authority
    keeps_query = ~absolute & (ref["path"] == "") & ~ref["has_query"]
    own_path = _encoded(ref["path"], _KEEP_PLAIN)
    path = (
        F.when(absolute | ref["path"].startswith("/"), own_path)
        .when(ref["path"] == "", base["path"])
        .otherwise(F.concat(F.regexp_extract(base["path"], r"^(.*/)?", 1), own_path))
    )
    fragment = F.when(keeps_query & (ref["fragment"] == ""), base["fragment"]).otherwise(
        _encoded_fragment(ref["fragment"])
    )
    escapes = F.concat(ref["path"], F.lit("|"), ref["fragment"])
    invalid = (
        href.rlike(r"[\x00-\x1f\x7f]")
        | (has_scheme & ~has_authority)
        | escapes.rlike(r"%(?:[^0-9A-Fa-f]|[0-9A-Fa-f][^0-9A-Fa-f]|.?$)")
        | (~absolute & F.substring_index(ref["path"], "/", 1).contains(":"))
    )
    return F.when(
        ~invalid,
        F.concat(
            F.when(has_scheme, F.lower(ref["scheme"])).otherwise(base["scheme"]),
            F.lit("://"),
            F.when(has_authority, ref["authority"]).otherwise(base["authority"]),
            bind(bind(path, _without_dots), _rooted),
            F.when(keeps_query, base["query"])
            .when(ref["has_query"], F.concat(F.lit("?"), ref["query"]))
            .otherwise(""),
            bind(fragment, lambda f: F.when(f != "", F.concat(F.lit("#"), f)).otherwise("")),
        ),
    )
