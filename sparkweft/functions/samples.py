"""Functions on labelled samples: variant of a test case, sample id, translation unit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What marks a body as C++, and what is put before a body without includes.
CPP_MARKERS = (
    "namespace ", "class ", "template<", "public:", "private:", "protected:", "std::", "using namespace", "::",
    "#include <iostream>", "#include <vector>", "#include <string>",
)
INCLUDES = ("#include <stdint.h>", "#include <stddef.h>")


def good_bad(path: Column) -> Column:
    """good, bad, mixed or unknown: by the last component that says so, else by the file's name."""
    parts = F.transform(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), F.lower)
    said = F.get(F.filter(F.reverse(parts), lambda x: x.isin("good", "bad")), F.lit(0))
    name = F.element_at(parts, -1)
    by_name = F.when(F.contains(name, F.lit("good")), "good").when(F.contains(name, F.lit("bad")), "bad").otherwise("mixed")
    return F.when(F.coalesce(path, F.lit("")) == "", "unknown").otherwise(F.coalesce(said, by_name))


def unit_extension(body: Column, path: Column) -> Column:
    """c or cpp: by the program's path where there is one, else by markers in the body."""
    there = F.coalesce(path, F.lit("")) != ""
    marked = F.lit(False)
    for marker in CPP_MARKERS:
        marked = marked | F.contains(body, F.lit(marker))
    by_path = F.endswith(path, F.lit(".cpp")) | F.endswith(path, F.lit(".cc"))
    return F.when(F.when(there, by_path).otherwise(F.coalesce(marked, F.lit(False))), "cpp").otherwise("c")


def has_includes(body: Column) -> Column:
    return F.coalesce(body, F.lit("")).rlike(r'(?U)#include\s*[<"]')


def unit_text(body: Column) -> Column:
    """The translation unit: a body without includes gets the least that it needs; the text ends in a line feed."""
    body = F.coalesce(body, F.lit(""))
    text = F.when(has_includes(body), body).otherwise(F.concat(F.lit("\n".join([*INCLUDES, "", ""])), body))
    return F.when(F.endswith(text, F.lit("\n")), text).otherwise(F.concat(text, F.lit("\n")))


def hash_prefix(value: Column, length: int = 12) -> Column:
    return F.substring(F.coalesce(value, F.lit("")), 1, length)
