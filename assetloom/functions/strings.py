"""File names, URLs and paths."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Characters not allowed in file names, white space as
# ``str.strip`` sees it (as a set and as a pattern), terminal colour codes,
# image formats, CJK range.
ILLEGAL = r'[<>:"/\\|?*]'
ILLEGAL_OR_BREAK = r'[<>:"/\\|?*\n\r\t]'
SPACES = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
ANSI_COLOUR = r"\x1b\[[0-9;]*m"
NOT_PRINTABLE_ASCII = r"[^\x20-\x7E]"
IMAGE_FORMATS = ("jpg", "jpeg", "png", "webp")
CJK = "[一-鿿]"
UNKNOWN = "Unknown"

_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#\[\]\s]+"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def strip(col: Column) -> Column:
    """Trim all white space; plain SQL ``trim`` removes blanks only."""
    return F.btrim(col, F.lit(SPACES))


def safe_name(col: Column) -> Column:
    """Illegal characters to ``_``."""
    return F.regexp_replace(col, ILLEGAL, "_")


def safe_name_stripped(col: Column) -> Column:
    """Illegal characters and line breaks to ``_``, ends trimmed."""
    return strip(F.regexp_replace(col, ILLEGAL_OR_BREAK, "_"))


def safe_title(col: Column, max_length: int = 100) -> Column:
    """Illegal characters to ``_``, white space collapsed, cut, never empty."""
    one_line = F.regexp_replace(strip(col), f"{SPACE}+", " ")
    clean = F.btrim(F.regexp_replace(one_line, ILLEGAL, "_"))
    cut = F.rtrim(F.substring(clean, 1, max_length))
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(UNKNOWN))


def ascii_only(col: Column) -> Column:
    return F.regexp_replace(col, NOT_PRINTABLE_ASCII, "")


def strip_colour(col: Column) -> Column:
    return F.regexp_replace(col, ANSI_COLOUR, "")


def has_cjk(col: Column) -> Column:
    return col.rlike(CJK)


def clean_url(col: Column, host_mark: str | None = None,
              prefix: str = "https://www.") -> Column:
    """Trim, drop trailing ``_`` and blanks; add ``prefix`` to a URL that holds
    ``host_mark`` but has no scheme."""
    url = F.rtrim(strip(col), F.lit("_" + SPACES))
    if host_mark is None:
        return url
    return F.when(url.contains(host_mark) & ~url.startswith("http"),
                  F.concat(F.lit(prefix), url)).otherwise(url)


def expand_id(col: Column, base: str) -> Column:
    """A bare id becomes ``base`` + id; URLs stay."""
    return F.when(col.rlike("^https?://"), col).otherwise(F.concat(F.lit(base), col))


def matches_any_prefix(col: Column, patterns: Iterable[str]) -> Column:
    """True if one of the patterns matches at the start."""
    return strip(col).rlike("^(?:" + "|".join(patterns) + ")")


def _query_value(url: Column, name: str) -> Column:
    found = F.regexp_extract(url, rf"^[^#?]*\?(?:[^#]*?&)?{name}=([^&#]+)", 1)
    return F.nullif(found, F.lit(""))


def url_file_name(url: Column, param: str = "dl") -> Column:
    """Name from the ``param`` query value, else the last path part; null if the
    text is no URL. Split before decoding, so an encoded ``/`` splits nothing."""
    named = F.try_url_decode(_query_value(url, param))
    last = F.element_at(F.split(F.regexp_extract(url, _PATH, 1), "/"), -1)
    from_path = F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))
    name = F.element_at(F.split(F.coalesce(named, from_path), "/"), -1)
    return F.when(url.rlike(_ABSOLUTE), name)


def url_format(url: Column, param: str = "fm", default: str = "jpg",
               allowed: Iterable[str] = IMAGE_FORMATS) -> Column:
    """Lower-case format named in the query if it is allowed, else ``default``."""
    asked = F.lower(F.try_url_decode(_query_value(url, param)))
    return F.when(asked.isin(*allowed), asked).otherwise(F.lit(default))


def url_id(url: Column, pattern: str) -> Column:
    """First group of ``pattern``, null when it does not match."""
    return F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))


def last_part(url: Column) -> Column:
    return F.element_at(F.split(url, "/"), -1)


def url_key(url: Column) -> Column:
    """Ledger key of a URL."""
    return F.md5(url)


def base_url(url: Column) -> Column:
    """Everything up to the last ``/`` of the path, with it; query and fragment do not count."""
    return F.regexp_replace(F.regexp_replace(url, "[?#].*", ""), "/[^/]*$", "/")


def without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` parts resolved; ``..`` above the root is dropped."""
    parts = F.split(path, "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, part:
                       F.when(part == ".", done)
                        .when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
                        .otherwise(F.concat(done, F.array(part))))
    return F.concat(F.array_join(kept, "/"), F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise(""))


def join_url(base: Column, ref: Column) -> Column:
    """``ref`` as seen from ``base``: absolute references pass; ``//host/x`` takes the scheme of
    ``base``, ``/x`` is resolved on its host, ``?q`` on its path, ``#f`` on all of it, others on its folder. ``.`` and
    ``..`` parts are resolved (RFC 3986, 5.2)."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    host = F.regexp_extract(base, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(//[^/?#]*)", 1)
    rest = F.substring(base, F.length(scheme) + F.length(host) + 1, F.length(base))
    base_path, base_query = F.regexp_extract(rest, r"^[^?#]*", 0), F.regexp_extract(rest, r"^[^?#]*(\?[^#]*)", 1)
    path, tail = F.regexp_extract(ref, r"^[^?#]*", 0), F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    folder = F.when((base_path == "") & (host != ""), "/").otherwise(F.regexp_extract(base_path, r"^(.*/)?", 0))
    whole = (F.when(path == "", F.concat(base_path, F.when(tail.startswith("?"), "").otherwise(base_query)))
              .when(path.startswith("/"), without_dots(path)).otherwise(without_dots(F.concat(folder, path))))
    return (F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
             .when(ref.startswith("//"), F.concat(scheme, ref))
             .otherwise(F.concat(scheme, host, whole, tail)))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Extension with its dot; dot files and names without one give ``''``."""
    return F.regexp_extract(base_name(path), r"(?s)^\.*[^.].*(\.[^.]*)$|^\.*[^.](\.[^.]*)$", 1)


def stem(path: Column) -> Column:
    name = base_name(path)
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(path)))


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``; null for paths elsewhere."""
    folder = root.rstrip("/") + "/"
    return F.when(path.startswith(folder), F.substring(path, F.lit(len(folder) + 1), F.length(path)))


def tag_text(tags: Column) -> Column:
    """Names of an array of ``struct<name>`` joined by commas."""
    return F.array_join(F.transform(tags, lambda t: t["name"]), ",")


def padded(n: Column, width: int = 3) -> Column:
    """Zero-padded number; wider numbers keep all digits (``lpad`` would cut)."""
    return F.format_string(f"%0{width}d", n)


def output_name(*parts: Column, ext: Column | str, sep: str = "_") -> Column:
    """Parts joined by ``sep`` plus an extension; null parts are left out."""
    tail = F.lit(ext) if isinstance(ext, str) else ext
    return F.concat(F.concat_ws(sep, *parts), tail)
