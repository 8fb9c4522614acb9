"""Captions, labels, model replies, paths and store addresses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelsift.functions.numbers import number


_CONTROL = {"n": "\n", "t": "\t", "r": "\r", "a": "\a", "f": "\f", "v": "\v"}


def stripped_blanks(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def truncate(x: Column, limit: int = 400) -> Column:
    c = collapse(x)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.left(c, F.lit(limit - 3)), F.lit("...")))


def replace_words(x: Column, rules: dict[str, str]) -> Column:
    """Whole words, in any case, one rule after another. Targets are templates, see ``template``."""
    for word, target in rules.items():
        x = F.regexp_replace(x, rf"(?iU)\b\Q{word}\E\b", template(target))
    return x


def template(target: str) -> str:
    """A replacement in Java's form: "\\g<0>" is the word found, "\\n", "\\t" and the like are control characters, "\\\\" is a backslash."""

    def one(m: re.Match) -> str:
        if m[1] is None:
            return "\\$" if m[0] == "$" else m[0]
        if m[1] == "g<0>":
            return "$0"
        if m[1] == "\\":
            return "\\\\"
        if m[1] in _CONTROL:
            return _CONTROL[m[1]]
        if m[1].isalnum():
            raise ValueError(f"bad escape \\{m[1]} in {target!r}")
        return "\\\\" + m[1]

    return re.sub(r"\\(g<0>|.)|\$", one, target, flags=re.S)


def content_label(x: Column, labels: tuple[str, ...]) -> Column:
    """A known label; any other is "other" where that is one, else null."""
    c = F.lower(stripped_blanks(x))
    out = F.when(c.isin(*labels), c)
    return out.otherwise(F.lit("other")) if "other" in labels else out


def json_object(reply: Column) -> Column:
    """The object between the first "{" and the last "}" of a reply as VARIANT; null if there is none."""
    start, end = F.locate("{", reply), F.length(reply) - F.locate("}", F.reverse(reply)) + 1
    found = (start > 0) & (F.locate("}", reply) > 0) & (end > start)
    return F.when(found, F.try_parse_json(F.substring(reply, start, end - start + 1)))


def unit_score(x: Column) -> Column:
    """0 to 1; numbers above 1 are percent; else null."""
    n = number(x)
    n = F.when(n > 1, n / 100).otherwise(n)
    return F.when((n >= 0) & (n <= 1), n)


def reply_score(reply: Column, name: str) -> Column:
    return unit_score(F.try_variant_get(json_object(reply), f"$.{name}", "string"))


def all_or_none_mean(x: Column) -> Column:
    """An aggregate: the mean, or null if any value is null."""
    return F.when(F.count(x) == F.count(F.lit(1)), F.avg(x))


def extension(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return F.lower(F.when(F.locate(".", F.ltrim(name, F.lit("."))) > 0, F.element_at(F.split(name, r"\."), -1)).otherwise(""))


def path_order(path: Column) -> Column:
    """Orders paths by their parts."""
    return F.split(path, "/")


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def path_id(path: Column) -> Column:
    return F.replace(F.regexp_replace(path, r"(?<=[^/])\.[^./]*$", ""), F.lit("/"), F.lit("__"))


def object_key(prefix: Column, name: Column) -> Column:
    return F.concat_ws("/", F.nullif(F.trim(F.trim(prefix), F.lit("/")), F.lit("")), name)


def store_bucket(url: Column) -> Column:
    return F.regexp_extract(url, r"^s3://([^/]*)", 1)


def store_prefix(url: Column) -> Column:
    return F.trim(F.regexp_extract(url, r"^s3://[^/]*/(.*)$", 1), F.lit("/"))
