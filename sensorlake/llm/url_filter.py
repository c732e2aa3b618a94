"""Rules on addresses, of which each address meets only a few.

A rule is a pattern: ``||`` in front stands for any subdomain, ``|`` for the start of
the host or the end of the address, ``*`` for anything and ``^`` for one character
that is no letter or digit, or the end. Letters and digits that stand between other
characters are tokens of it: an address that fits has them as whole tokens. Each rule
lies in an index under the one of its tokens that the fewest addresses have, or under
no token if it has none; the tokens of an address fetch its candidates, and only
their regular expressions run. Of the rules that fit, those of the lowest tier count,
then the longest name, then the first in order.

Addresses are judged where they are read, without a shuffle. Rules are broadcast, at
most ``MOST_RULES`` in one pass; more are dealt to several passes, and each address
keeps the best of all.

Defined cases: an address that is null, or has no ``://``, has an empty host and path
and meets only rules that fit the empty ones; hosts are compared in lower case, paths
as they are; repeated and very long addresses are judged like others; columns of other
names are left out, whatever they are called; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.llm.collocations import LOWER, UPPER
from sensorlake.llm.common import materialize

#: Rules of one pass, about 200 bytes each on the driver and in a worker.
MOST_RULES = 500_000

RULES = "name string, pattern string, verdict string, tier int"
_TOKEN = re.compile("[0-9A-Za-z]+")
_SEPARATOR = "(?:[^0-9A-Za-z]|\\Z)"


def host(url: str | Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; lower case."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER)


def path(url: str | Column) -> Column:
    """After the host up to a question mark, hash or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def address(url: str | Column) -> Column:
    """What patterns are matched with: two slashes, the host, and all that follows it."""
    tail = F.regexp_extract(_rest(url), "^[^/?#]*((?s:.*))", 1)
    return F.concat(F.lit("//"), host(url), tail)


def _rest(url: str | Column) -> Column:
    column = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    return F.regexp_extract(column, "^(?s:.*?)://((?s:.*))$", 1)


# --- patterns ---------------------------------------------------------------


def _pieces(pattern: str) -> tuple[str, str, bool]:
    """What stands for the beginning, the pattern without its ends, whether the end is fixed."""
    start = ""
    if pattern.startswith("||"):
        start, pattern = "^//(?:[^/?#]*\\.)?", pattern[2:]
    elif pattern.startswith("|"):
        start, pattern = "^//", pattern[1:]
    fixed = pattern.endswith("|")
    return start, pattern[: len(pattern) - fixed], fixed


def expression(pattern: str) -> str:
    start, inner, fixed = _pieces(pattern)
    special = {"*": ".*", "^": _SEPARATOR}
    return start + "".join(special.get(c) or re.escape(c) for c in inner) + "\\Z" * fixed


def tokens(pattern: str) -> set[str]:
    """Tokens that every address fitting the pattern has, in lower case."""
    start, inner, fixed = _pieces(pattern)
    found = set()
    for run in _TOKEN.finditer(inner):
        begin, end = run.span()
        whole_left = inner[begin - 1] != "*" if begin else bool(start)
        whole_right = inner[end] != "*" if end < len(inner) else fixed
        if whole_left and whole_right:
            found.add(run.group().lower())
    return found


class Index:
    """Rules by one token each; expressions are compiled when first fetched."""

    def __init__(self, rules: Iterable[tuple], counts: dict[str, int]):
        self._rules: dict[str, list[tuple]] = defaultdict(list)
        self._compiled: dict[str, re.Pattern] = {}
        for name, pattern, verdict, tier in rules:
            rarest = min(tokens(pattern), key=lambda t: (counts.get(t, 0), t), default="")
            self._rules[rarest].append(((tier, -len(name), name, verdict), pattern))
        for entries in self._rules.values():
            entries.sort()

    def __getstate__(self):
        return {"_rules": dict(self._rules), "_compiled": {}}

    def candidates(self, address: str) -> list[tuple]:
        keys = {"", *(t.lower() for t in _TOKEN.findall(address))}
        return [entry for key in keys for entry in self._rules.get(key, ())]

    def best(self, address: str) -> tuple | None:
        """The first of the rules that fit; those after it are not tried."""
        for rule, pattern in sorted(self.candidates(address)):
            fits = self._compiled.get(pattern)
            if fits is None:
                fits = self._compiled[pattern] = re.compile(expression(pattern), re.DOTALL)
            if fits.search(address):
                return rule
        return None


# --- tables -----------------------------------------------------------------


def _token_counts(addresses: DataFrame, wanted: Iterable[str]) -> dict[str, int]:
    """In how many addresses each of the wanted tokens occurs."""
    spark = addresses.sparkSession
    known = spark.createDataFrame([(t,) for t in sorted(wanted)], "token string")
    runs = F.regexp_extract_all("address", F.lit("[0-9A-Za-z]+"), 0)
    lowered = F.transform(runs, lambda t: F.translate(t, UPPER, LOWER))
    seen = addresses.select(F.explode(F.array_distinct(lowered)).alias("token"))
    counted = seen.join(F.broadcast(known), "token", "left_semi").groupBy("token").count()
    return {row["token"]: row["count"] for row in counted.collect()}


_FOUND = T.StructType(
    [
        T.StructField("tier", T.IntegerType()),
        T.StructField("short", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("verdict", T.StringType()),
    ]
)
_ARROW = pa.struct(
    [("tier", pa.int32()), ("short", pa.int32()), ("name", pa.string()), ("verdict", pa.string())]
)


def _matcher(held):
    @F.arrow_udf(_FOUND)
    def match(addresses: pa.Array) -> pa.Array:
        index = held.value
        rows = [index.best(a) for a in addresses.to_pylist()]
        made = [None if row is None else dict(zip(_FOUND.names, row)) for row in rows]
        return pa.array(made, _ARROW)

    return match


def judged(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    most_rules: int = MOST_RULES,
) -> DataFrame:
    """The id, ``host``, ``path``, and of the rule that counts ``rule``, ``tier``, ``verdict``.

    ``rules`` has the columns ``RULES``. The last three are null where no rule fits.
    """
    spark = pages.sparkSession
    rules = rules.select("name", "pattern", "verdict", "tier")
    passes = max(1, -(-rules.count() // most_rules))
    found = pages.select(
        F.col(id_col), host(url_col).alias("host"), path(url_col).alias("path"),
        address(url_col).alias("address"), F.lit(None).cast(_FOUND).alias("best"),
    )
    for turn in range(passes):
        mine = F.pmod(F.xxhash64("name", "pattern"), F.lit(passes)) == turn
        some = [tuple(row) for row in rules.where(mine).collect()]  # bounded by ``most_rules``
        wanted = {t for _, pattern, _, _ in some for t in tokens(pattern)}
        index = Index(some, _token_counts(found, wanted) if wanted else {})
        match = _matcher(spark.sparkContext.broadcast(index))
        found = found.withColumn("best", F.least("best", match("address")))
        if turn + 1 < passes:
            found = materialize(found, "url-pass")
    return found.select(
        id_col, "host", "path",
        F.col("best.name").alias("rule"), F.col("best.tier").alias("tier"),
        F.col("best.verdict").alias("verdict"),
    )
