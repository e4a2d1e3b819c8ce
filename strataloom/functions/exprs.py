"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The suffixes of source code that are kept, in the order of the columns of the summary per repository.
CODE_SUFFIXES = [".js", ".py", ".c", ".java", ".go", ".ts", ".cpp", ".php", ".rb", ".cs", ".cc", ".rs", ".tsx", ".scala", ".jsx"]

#: The actions that file types stand for, with their encoding; a binary action has files but no lines.
ACTIONS = {
    "img": ("binary", ["png", "jpg", "gif", "drawio", "svg"]),
    "noextbin": ("binary", ["noextbin"]),
    "c": ("text", ["c", "h"]),
    "c-plus-plus": ("text", ["cpp", "hpp"]),
    "clojure": ("text", ["clj"]),
    "configuration": ("text", ["ini", "cfg", "conf", "in"]),
    "data": ("text", ["csv"]),
    "datascience": ("text", ["ipynb"]),
    "gitignore": ("text", ["gitignore"]),
    "go": ("text", ["go"]),
    "interface": ("text", ["html", "css", "scss", "less"]),
    "javascript": ("text", ["js", "jsx", "ts", "tsx", "vue"]),
    "json": ("text", ["json"]),
    "latex": ("text", ["bst", "tex"]),
    "lock": ("text", ["lock"]),
    "localization": ("text", ["po"]),
    "markdown": ("text", ["md"]),
    "noextext": ("text", ["noextext"]),
    "pydata": ("text", ["rst"]),
    "python": ("text", ["py", "pyx"]),
    "rpm-package": ("text", ["spec"]),
    "rust": ("text", ["rs", "toml"]),
    "php": ("text", ["php"]),
    "shell": ("text", ["sh"]),
    "solidity": ("text", ["sol"]),
    "sql": ("text", ["sql"]),
    "swift": ("text", ["swift"]),
    "txt": ("text", ["txt"]),
    "yarn": ("text", ["yml", "yaml"]),
}


def file_extension(path: Column | str) -> Column:
    """From the last dot of the path on, '' without a dot; a leading dot counts like any other."""
    path = F.col(path) if isinstance(path, str) else path
    return F.when(F.instr(path, ".") > 0, F.concat(F.lit("."), F.substring_index(path, ".", -1))).when(path.isNotNull(), F.lit(""))


def author_name(author: Column | str) -> Column:
    """Name in ``Name <address>``, '' if the form doesn't match."""
    return F.regexp_extract(author, "(.*) <(.*)>", 1)


def author_email(author: Column | str) -> Column:
    """Address in ``Name <address>``, '' if the form doesn't match."""
    return F.regexp_extract(author, "(.*) <(.*)>", 2)


def synthetic_author(name: Column | str, email: Column | str) -> Column:
    """``Name <address>`` out of both, null if either is."""
    return F.concat(name, F.lit(" <"), email, F.lit(">"))


def percent_capped(part: Column, whole: Column) -> Column:
    """``percent`` with what exceeds 100 cut to 100."""
    return F.least(percent(part, whole), F.lit(100.0))


def email_domain(email: Column | str) -> Column:
    return F.regexp_extract(email, "(.*)@(.*)", 2)


def partition_key(owner_repo: Column | str) -> Column:
    """``pk`` and the first two hex digits of the md5 of owner/repo: 256 even buckets but for the repositories' sizes."""
    return F.concat(F.lit("pk"), F.substring(F.md5(owner_repo), 1, 2))


def percent(part: Column, whole: Column) -> Column:
    """Percentage cut (not rounded) to two places; 0 of anything is 0, anything of 0 is 100."""
    return F.when(part == 0, F.lit(0.0)).when(whole == 0, F.lit(100.0)).otherwise(F.floor(part.cast("double") * 10000 / whole) / 100)


def quarter_of(month: Column) -> Column:
    return F.floor((month + 2) / 3).cast("int")


def midpoint(first: Column, last: Column) -> Column:
    """Time half-way between two times, in whole seconds."""
    return F.floor((F.unix_seconds(first.cast("timestamp")) + F.unix_seconds(last.cast("timestamp"))) / 2)
