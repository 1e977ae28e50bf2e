"""URL and HTML-link expressions, all built-in (JVM-side) Spark functions.

Parsing follows the generic URI split (scheme ':' '//' netloc path '?' query
'#' fragment) with regular expressions, so a malformed URL never raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY_RE = r"^[^?#]*\?([^#]*)"
# attribute text of an <a> start tag; a quoted value may hold '>'; possessive, so that a tag of any length needs no stack
ANCHOR_RE = r"""(?is)<a(?=[\s/])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
# value of the first attribute named exactly href, after whole other attributes
HREF_RE = r"""(?is)^(?:[\s/]*+(?!href[\s=/>])[^\s=/>"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']++))?+)*+[\s/]*+href\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"']*+)"""
# character references decoded in attribute values
NAMED_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\u00a0"))
COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_RE = r"(?is)<script\b.*?</script\s*>"
# hrefs never followed: absolute http(s) links, fragments, javascript
SKIPPED_HREF_PREFIXES = ("http", "#", "javascript:")
# parent / self / root links dropped from a listing
PARENT_LINKS = ("../", "./", "/")
# --- end of fixed values ----------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_scheme(url) -> Column:
    return F.regexp_extract(_c(url), SCHEME_RE, 1)


def url_netloc(url) -> Column:
    return F.regexp_extract(_c(url), NETLOC_RE, 1)


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), PATH_RE, 1)


def url_basename(url) -> Column:
    """Last path segment (the file name) of a URL; '' for a directory URL."""
    return F.regexp_extract(url_path(url), r"([^/]*)$", 1)


def normalize_seed(url) -> Column:
    """Append '/' unless the URL already ends with '/' or names a file."""
    u = _c(url)
    return F.when(~u.endswith("/") & ~url_basename(u).contains("."), F.concat(u, F.lit("/"))).otherwise(u)


def destination_folder(url, base) -> Column:
    """``base/netloc/<path directories>``: the mirror folder of a URL."""
    u = _c(url)
    parts = F.split(F.regexp_replace(url_path(u), r"^/+|/+$", ""), "/")
    last = F.element_at(parts, -1)
    dirs = F.when(last.contains("."), F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    # a page at the host's root has no directories: empty parts are not folders
    return F.array_join(F.filter(F.concat(F.array(_c(base), url_netloc(u)), dirs), lambda p: p != ""), "/")


def path_to_url(rel_path) -> Column:
    """Relative mirror path ``host/dir/file`` -> ``https://host/dir/file``.

    NULL when the path has a single part (no host directory).
    """
    parts = F.split(_c(rel_path), "/")
    return F.when(F.size(parts) > 1, F.concat(
        F.lit("https://"), F.element_at(parts, 1), F.lit("/"),
        F.array_join(F.slice(parts, 2, F.size(parts) - 1), "/")))


def _remove_dot_segments(segs: Column) -> Column:
    """Resolve '.' and '..' over an array of path segments (RFC 3986)."""
    empty = F.array().cast("array<string>")
    resolved = F.aggregate(
        segs, empty,
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segs, -1)
    resolved = F.when(last.isin(".", ".."), F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    return F.array_join(resolved, "/")


def resolve_link(base, href) -> Column:
    """``urljoin(base, href)`` for hierarchical URLs, as an expression (leading blanks dropped, as there)."""
    b, h = _c(base), F.regexp_replace(F.regexp_replace(_c(href), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    b_scheme, b_netloc, b_path = url_scheme(b), url_netloc(b), url_path(b)
    b_query = F.regexp_extract(b, QUERY_RE, 1)
    h_path = F.regexp_extract(h, r"^([^?#]*)", 1)
    h_rest = F.regexp_extract(h, r"^[^?#]*(.*)$", 1)
    origin = F.concat(b_scheme, F.lit("://"), b_netloc)

    def with_root(p: Column) -> Column:
        joined = F.when(p == "", F.lit("/")).otherwise(p)
        return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))

    absolute = with_root(_remove_dot_segments(F.split(h_path, "/")))
    base_dir = F.split(b_path, "/")
    base_dir = F.when(F.element_at(base_dir, -1) != "", F.slice(base_dir, 1, F.size(base_dir) - 1)).otherwise(base_dir)
    merged = F.concat(base_dir, F.split(h_path, "/"))
    merged = F.filter(merged, lambda s, i: (i == 0) | (i == F.size(merged) - 1) | (s != ""))
    relative = with_root(_remove_dot_segments(merged))
    keep_query = F.when(b_query != "", F.concat(F.lit("?"), b_query)).otherwise(F.lit(""))
    return (
        F.when(h.rlike(SCHEME_RE), h)
        .when(h.startswith("//"), F.concat(b_scheme, F.lit(":"), h))
        .when(h_path == "", F.concat(origin, b_path,
                                     F.when(h_rest.startswith("?"), h_rest)
                                     .otherwise(F.concat(keep_query, h_rest))))
        .when(h_path.startswith("/"), F.concat(origin, absolute, h_rest))
        .otherwise(F.concat(origin, relative, h_rest))
    )


def strip_markup_noise(html) -> Column:
    """Remove comments and script bodies, where anchors are not links."""
    return F.regexp_replace(F.regexp_replace(_c(html), COMMENT_RE, ""), SCRIPT_RE, "")


def decode_references(text: Column) -> Column:
    """Numeric and the common named character references, ``&amp;`` last."""
    def code_point(ref: Column) -> Column:
        digits = F.regexp_extract(ref, r"&#[xX]?([0-9a-fA-F]+);", 1)
        utf32 = F.when(ref.rlike("^&#[xX]"), F.lpad(digits, 8, "0")).otherwise(F.lpad(F.conv(digits, 10, 16), 8, "0"))
        return F.decode(F.unhex(utf32), "UTF-32")

    numeric = F.array_distinct(F.regexp_extract_all(text, F.lit("(&#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7});)"), F.lit(1)))
    out = F.aggregate(numeric, text, lambda acc, ref: F.replace(acc, ref, code_point(ref)))
    for ref, char in NAMED_REFERENCES:
        out = F.replace(out, F.lit(ref), F.lit(char))
    return F.when(text.contains("&"), F.replace(out, F.lit("&amp;"), F.lit("&"))).otherwise(text)


def anchor_hrefs(html) -> Column:
    """Array of href values of all ``<a>`` tags, character references decoded.

    Quoted values are taken whole (with spaces and the other quote), bare ones
    up to white space; only an attribute named exactly ``href`` counts, and an
    anchor without one gives no entry.
    """
    tags = F.regexp_extract_all(strip_markup_noise(html), F.lit(ANCHOR_RE), F.lit(1))
    tags = F.filter(tags, lambda t: t.rlike(HREF_RE))

    def value(t: Column) -> Column:
        raw = F.regexp_extract(t, HREF_RE, 1)
        quoted = raw.startswith('"') | raw.startswith("'")
        return decode_references(F.when(quoted, raw.substr(F.lit(2), F.length(raw) - 2)).otherwise(raw))

    return F.transform(tags, value)


def is_followable(href) -> Column:
    """Relative link of a listing (not http*, '#...', 'javascript:...')."""
    h = _c(href)
    cond = h != ""
    for p in SKIPPED_HREF_PREFIXES:
        cond = cond & ~h.startswith(p)
    return cond


def is_kept_link(href) -> Column:
    """Followable and not a parent/self/root link."""
    return is_followable(href) & ~_c(href).isin(*PARENT_LINKS)


def is_directory_page(url, hrefs) -> Column:
    """URL ends with '/' and lists at least one relative dir or file link."""
    return _c(url).endswith("/") & F.exists(
        _c(hrefs), lambda h: is_followable(h) & (h.endswith("/") | h.contains(".")))
