"""Secret scans with linking of credential parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from assetloom.llm.text import whole

# The patterns of the base kinds.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

# Parts that say little alone.
WEAK_ID = (r"""(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}|(?i:client_?id|key_?id|user_?name|login)["']?"""
           r"""\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""")
WEAK_SECRET = r"[A-Za-z0-9+/]{32,}={0,2}"
ENDPOINT = r"""[a-z][a-z0-9+]{1,12}://[^\s"'<>]{3,}"""

KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")
BASE = KINDS[:3]
ID, SECRET, PLACE = 0, 1, 2
#: Part each kind can play.
ROLE = {"assign": SECRET, "access": ID, "hex": SECRET, "weak_id": ID, "weak_secret": SECRET,
        "endpoint": PLACE}
#: Code points between two parts of one scope.
SCOPE = 200

_SPAN = "struct<start:int,kind:int,end:int>"
_FAR = 1 << 30


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _walk(items: Column, state: dict[str, Column],
          step: Callable[[Column, Column], tuple[dict[str, Column], Column]], kind: str) -> Column:
    """Pass over ``items`` in order and collect what ``step`` tells: the new state and an array of
    ``kind`` to add, null for none.

    Adding to an array copies it. So the items are taken in blocks of about the root of their number: an array
    of a block is added to within the block, and once to the array of blocks.
    """
    none = F.array().cast(f"array<{kind}>")

    def inner(so_far: Column, item: Column) -> Column:
        new, told = step(so_far, item)
        out = F.when(told.isNull(), so_far["out"]).otherwise(F.concat(so_far["out"], told))
        return F.struct(*(c.alias(n) for n, c in new.items()), out.alias("out"))

    def outer(so_far: Column, block: Column) -> Column:
        start = F.struct(*(so_far["now"][n].alias(n) for n in state), none.alias("out"))
        return F.struct(F.aggregate(block, start, inner).alias("now"),
                        F.concat(so_far["done"], F.array(so_far["now"]["out"])).alias("done"))

    def whole_walk(own: Column) -> Column:
        width = F.greatest(F.lit(32), F.ceil(F.sqrt(F.size(own))).cast("int"))
        blocks = F.transform(F.sequence(F.lit(1), F.greatest(F.size(own), F.lit(1)), width), lambda i: F.slice(own, i, width))
        first = F.struct(F.struct(*(c.alias(n) for n, c in state.items()), none.alias("out")).alias("now"),
                         F.array().cast(f"array<array<{kind}>>").alias("done"))
        return F.aggregate(blocks, first, outer,
                           lambda s: F.flatten(F.concat(s["done"], F.array(s["now"]["out"]))))

    return _let(items, whole_walk)


def _spans(text: Column, kind: str, pattern: str, ok=None) -> Column:
    """Leftmost non-overlapping matches as sorted (start, kind, end), in code points.

    The pieces between matches and the matches alternate, so a running sum of their
    lengths gives the places.
    """
    number = KINDS.index(kind)
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(pieces.alias("piece"), found.alias("match"))

    def step(so_far: Column, pair: Column) -> tuple[dict[str, Column], Column]:
        begin = so_far["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["match"])
        span = F.array(F.struct(begin.alias("start"), F.lit(number).alias("kind"), end.alias("end")))
        good = pair["match"].isNotNull() if ok is None else pair["match"].isNotNull() & ok(pair["match"])
        return {"at": F.coalesce(end, begin)}, F.when(good, span)

    walked = _walk(pairs, {"at": F.lit(0)}, step, _SPAN)
    return F.when(text.rlike(pattern), walked).otherwise(F.array().cast(f"array<{_SPAN}>"))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*(F.lit(ROLE[k]) for k in KINDS)), kind + 1)


def _sweep(parts: Column, forward: bool, keep: list[str]) -> Column:
    """Pass over parts in order, giving each the nearest edge of every role so far."""
    side = "before" if forward else "after"
    names = [f"{side}_{r}" for r in (ID, SECRET, PLACE)] + [f"{side}_base"]
    none = -_FAR if forward else _FAR
    kind = f"struct<start:int,kind:int,end:int,{','.join(f'{n}:int' for n in (*keep, *names))}>"

    def step(so_far: Column, part: Column) -> tuple[dict[str, Column], Column]:
        edge = part["end"] if forward else part["start"]
        best = F.greatest if forward else F.least
        role = _role(part["kind"])
        told = F.array(F.struct(
            *(part[n].alias(n) for n in ("start", "kind", "end", *keep)), *(so_far[n].alias(n) for n in names)))
        new = {f"{side}_{r}": F.when(role == r, best(so_far[f"{side}_{r}"], edge)).otherwise(so_far[f"{side}_{r}"])
               for r in (ID, SECRET, PLACE)}
        new[f"{side}_base"] = F.when(part["kind"] < len(BASE), best(so_far[f"{side}_base"], edge)).otherwise(
            so_far[f"{side}_base"])
        return new, told

    return _walk(parts, {n: F.lit(none) for n in names}, step, kind)


def _linked(parts: Column, scope: int) -> Column:
    """Weak parts whose complement stands within ``scope`` on either side."""
    both = _sweep(F.reverse(_sweep(parts, True, [])), False,
                  [f"before_{r}" for r in (ID, SECRET, PLACE)] + ["before_base"])

    def near(p: Column, role: int) -> Column:
        return ((p["start"] - p[f"before_{role}"] <= scope) | (p[f"after_{role}"] - p["end"] <= scope))

    def good(p: Column) -> Column:
        role = _role(p["kind"])
        free = (p["before_base"] <= p["start"]) & (p["after_base"] >= p["end"])
        return (p["kind"] >= len(BASE)) & free & (
            F.when(role == ID, near(p, SECRET)).when(role == SECRET, near(p, ID))
             .otherwise(near(p, ID) & near(p, SECRET)))

    return F.transform(F.filter(both, good), lambda p: F.struct(
        p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))


def _told(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, text: str = "text", scope: int = SCOPE) -> DataFrame:
    """Add ``base_spans`` and ``linked_spans`` (arrays of start, kind number, end).

    Base kinds are reported wherever they match. Weak parts (identifiers, secrets that
    are mere long tokens, endpoints) are reported only beside their complement: an
    identifier beside a secret, a secret beside an identifier, an endpoint beside
    both, at most ``scope`` code points away; base spans count as parts. The interval
    join runs inside the row as two sweeps over the parts in order, which carry the
    nearest part of each role and so look at no pairs; no shuffle is needed. A weak part
    that overlaps a base span is that span and is not told again.

    Null and empty texts have no spans. Rows are judged alone, so repeated rows, ties
    and null keys change nothing. Columns of the two names are replaced.
    """
    t = whole(text)
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8
    mixed_case = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    parts = docs.drop("base_spans", "linked_spans").withColumns({
        "base_spans": F.array_sort(F.concat(
            _spans(t, "assign", ASSIGN, value), _spans(t, "access", ACCESS), _spans(t, "hex", HEX))),
        "linked_spans": F.array_sort(F.concat(
            _spans(t, "weak_id", WEAK_ID), _spans(t, "weak_secret", WEAK_SECRET, mixed_case),
            _spans(t, "endpoint", ENDPOINT))),
    })
    everything = F.array_sort(F.concat("base_spans", "linked_spans"))
    return parts.withColumn("linked_spans", F.when(
        F.size("linked_spans") > 0, F.array_sort(_linked(everything, scope))).otherwise(F.col("linked_spans")))


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    found = find_secrets(docs.select("doc_id", "text"), scope=scope)
    count = lambda kind: F.size(F.filter(
        "base_spans", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(_told(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _told(F.array_sort(F.concat("base_spans", "linked_spans"))).alias("spans"))
