"""Parsers of version-control logs: each file is one row of text and is parsed in one task."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT_SCHEMA = """source string, commit_id string, author string, date timestamp, orig_timezone string, comment string,
filetypes map<string,struct<inserts:bigint,deletes:bigint,occurrences:bigint>>,
file_list map<string,struct<binary:int,inserts:bigint,deletes:bigint>>"""
BLAME_SCHEMA = "source string, file_path string, author string, blame_type string, commit_id string, epoch bigint, time_zone string, lines int"


def read_logs(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Whole text files (bz2 too) below a folder: source, text."""
    reader = spark.read.option("wholetext", True).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    return reader.text(path).select(F.input_file_name().alias("source"), F.col("value").alias("text"))


def type_of(path: str) -> str:
    """File type of a path: what follows the last dot of the name; noexttext without one or with a leading one alone."""
    name = path.rstrip("}").rpartition("/")[2]
    return name.rpartition(".")[2].rstrip("}").lower() if "." in name[1:] else "noexttext"


def _numstat_line(line: str) -> tuple[str, int, int, bool] | None:
    """(path, inserts, deletes, binary) of a numstat line."""
    if m := re.match(r"(\d+|-)\t(\d+|-)\t(.+)$", line):
        binary = m.group(1) == "-" or m.group(2) == "-"
        return (m.group(3), 0, 0, True) if binary else (m.group(3), int(m.group(1)), int(m.group(2)), False)
    return None


def _stat_line(line: str) -> tuple[str, int, int, bool] | None:
    """The same of a ``--stat`` line."""
    found = parse_stat_line(line)
    return found and (*found[:3], "| Bin" in re.sub(r"\|\s+", "| ", line))


def parse_commits(text: str, read_line: Callable[[str], tuple[str, int, int, bool] | None] = _numstat_line, bare_binary: str = "noexttext") -> Iterator[dict]:
    """Commits of a ``git log`` text whose lines of files are read by ``read_line``; binary files without a suffix have the
    type ``bare_binary``. Merges without lines come out with empty maps; a date that can't be read
    is null; lines of any other form belong to the comment."""
    commit: dict | None = None
    for line in text.splitlines():
        if m := re.match(r"commit ([0-9a-f]{7,64})\b", line):
            if commit:
                yield commit
            commit = {"commit_id": m.group(1), "author": None, "date": None, "orig_timezone": None, "comment": [], "filetypes": {}, "file_list": {}}
        elif commit is None or line.startswith("Merge:"):
            continue
        elif line.startswith("Author:") and commit["author"] is None:
            commit["author"] = line[7:].strip()
        elif line.startswith("Date:") and commit["date"] is None:
            try:
                when = datetime.strptime(line[5:].strip(), "%a %b %d %H:%M:%S %Y %z")
                commit["date"], commit["orig_timezone"] = when.astimezone(timezone.utc), line.strip()[-5:]
            except ValueError:
                pass
        elif (found := read_line(line)) is not None:
            path, inserts, deletes, binary = found
            old = commit["file_list"].get(path)
            commit["file_list"][path] = {"binary": old["binary"] if old else int(binary), "inserts": inserts + (old["inserts"] if old else 0), "deletes": deletes + (old["deletes"] if old else 0)}
            name = type_of(path)
            kind = commit["filetypes"].setdefault(bare_binary if binary and name == "noexttext" else name, {"inserts": 0, "deletes": 0, "occurrences": 0})
            kind["inserts"] += inserts
            kind["deletes"] += deletes
            kind["occurrences"] += 1
        elif line.startswith("    "):
            commit["comment"].append(line[4:])
    if commit:
        yield commit


def parse_numstat(text: str) -> Iterator[dict]:
    """Commits of a ``git log --numstat`` text."""
    return parse_commits(text)


def parse_stat(text: str) -> Iterator[dict]:
    """Commits of a ``git log --stat`` text; lines inserted and deleted are what the signs shown say."""
    return parse_commits(text, _stat_line, "noextbin")


def stat_commits(logs: DataFrame) -> DataFrame:
    """Commits of whole-text ``--stat`` logs (source, text)."""
    return numstat_commits(logs, parse_stat)


def numstat_commits(logs: DataFrame, parser: Callable[[str], Iterator[dict]] = parse_numstat) -> DataFrame:
    """Commits of whole-text logs (source, text), by default with numstat lines."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{"source": s} | c | {"comment": "\n".join(c["comment"]).strip()} for s, t in zip(batch["source"], batch["text"]) for c in parser(t or "")]
            out = pd.DataFrame(rows, columns=["source", "commit_id", "author", "date", "orig_timezone", "comment", "filetypes", "file_list"])
            out["date"] = pd.to_datetime(out["date"], utc=True).dt.tz_convert(None).astype("datetime64[us]")
            yield out

    return logs.select("source", "text").mapInPandas(parse, COMMIT_SCHEMA)


def parse_blame(text: str) -> Iterator[tuple[str, str, str, str, int | None, str | None]]:
    """(file, name {address}, blame_type, commit, epoch, time zone) per line of ``git blame --line-porcelain``: one for
    its author and one for its committer."""
    head: dict[str, str] = {}
    commit = ""
    for line in text.splitlines():
        if line.startswith("\t"):
            for kind, who in (("author_hash_map", "author"), ("commit_hash_map", "committer")):
                if who in head:
                    epoch = head.get(f"{who}-time", "")
                    address = head.get(f"{who}-mail", "").strip("<>")
                    yield head.get("filename", ""), f"{head[who]} {{{address}}}", kind, commit, int(epoch) if epoch.lstrip("-").isdigit() else None, head.get(f"{who}-tz")
            head = {}
        elif m := re.match(r"([0-9a-f]{40,64}) \d+ \d+", line):
            commit = m.group(1)
        else:
            key, _, value = line.partition(" ")
            head[key] = value


def blame_lines(porcelain: DataFrame) -> DataFrame:
    """Lines per file, author, blame type and commit of whole-text blame output (source, text)."""
    fields = ["source", "file_path", "author", "blame_type", "commit_id", "epoch", "time_zone"]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([(s, *x) for s, t in zip(batch["source"], batch["text"]) for x in parse_blame(t or "")], columns=fields)
            yield rows.groupby(fields, dropna=False, as_index=False).size().rename(columns={"size": "lines"}).astype({"epoch": "Int64", "lines": "int32"})

    rows = porcelain.select("source", "text").mapInPandas(parse, BLAME_SCHEMA)
    return rows.groupBy(*fields).agg(F.sum("lines").cast("int").alias("lines"))


def fast_blame(porcelain: DataFrame) -> DataFrame:
    """Per source and author the lines and commits of a porcelain blame (source, text), by its group headers alone: source,
    author, line_count, commit_count. A header tells how many lines its group has; a commit's later groups have the header
    line only and count for the author of its first one."""
    head = r"(?m)^([0-9a-f]{40}) \d+ \d+ (\d+)$"
    named = r"(?m)^([0-9a-f]{40}) \d+ \d+ \d+\nauthor ([^\n]*)\nauthor-mail <([^>\n]*)>"
    groups = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(head), F.lit(i)).alias(n) for i, n in ((1, "commit_id"), (2, "lines"))])
    people = F.arrays_zip(*[F.regexp_extract_all("text", F.lit(named), F.lit(i)).alias(n) for i, n in ((1, "commit_id"), (2, "name"), (3, "mail"))])
    rows = porcelain.select("source", F.explode(groups).alias("g")).groupBy("source", "g.commit_id").agg(F.sum(F.col("g.lines").cast("bigint")).alias("lines"))
    who = porcelain.select("source", F.explode(people).alias("p")).select("source", "p.commit_id", F.concat("p.name", F.lit(" {"), "p.mail", F.lit("}")).alias("author")).distinct()
    return rows.join(who, ["source", "commit_id"]).groupBy("source", "author").agg(F.sum("lines").alias("line_count"), F.countDistinct("commit_id").alias("commit_count"))


def listing(lines: DataFrame, column: str = "value") -> DataFrame:
    """Object listing lines ``date time size .../owner/repo/file_type``: owner, repo_name, file_type, path, size."""
    part = F.split(F.trim(F.col(column)), " +")
    path = F.split(part[3], "/")
    rows = lines.where(F.size(part) == 4).select(part[2].cast("bigint").alias("size"), part[3].alias("path"), path.alias("p")).where("size(p) >= 3")
    return rows.select(F.element_at("p", -3).alias("owner"), F.element_at("p", -2).alias("repo_name"), F.element_at("p", -1).alias("file_type"), "path", "size")


def repaired_json(text, schema: str):
    """JSON by schema, tried once more with a closing bracket if it was cut off."""
    return F.coalesce(F.from_json(text, schema, {"mode": "PERMISSIVE"}), F.from_json(F.concat(text, F.lit("]")), schema))


def parse_stat_line(line: str) -> tuple[str, int, int, int] | None:
    """(path, inserts, deletes, bytes) of a ``git log --stat`` line; the changed lines are divided by the signs shown.

    ``path | 12 ++--`` has lines, ``path | Bin 10 -> 20 bytes`` the new size; other lines are None.
    """
    if m := re.match(r"\s(.+?)\s+\|\s+Bin(?: (\d+) -> (\d+) bytes)?\s*$", line):
        return m.group(1), 0, 0, int(m.group(3) or 0)
    if m := re.match(r"\s(.+?)\s+\|\s+(\d+)\s*(\+*)(-*)\s*$", line):
        changed, plus, minus = int(m.group(2)), len(m.group(3)), len(m.group(4))
        inserts = round(changed * plus / (plus + minus)) if plus + minus else 0
        return m.group(1), inserts, changed - inserts if plus + minus else 0, 0
    return None


#: Schema of commit documents as they are read from files.
COMMIT_FILE = "commit string, Author string, Date string, comment string, fileTypes map<string,struct<inserts:bigint,deletes:bigint,occurrences:bigint>>"


def commit_files(spark: SparkSession, path: str, name: str, start: int = 0, quant: int = 0, seed: int = 1) -> DataFrame:
    """Commits of the JSON files called ``name`` below a folder, bz2 or plain: their fields, ``seen_in`` (owner/project of the
    path), ``author_hash`` and the date in UTC.

    With ``quant`` the files from ``start`` on of a seeded order, so many of them: a sampling of files.
    """
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).schema(COMMIT_FILE)
    rows = reader.json(path).withColumn("source", F.input_file_name())
    if quant > 0:
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).format("binaryFile").load(path).select(F.col("path").alias("file"))
        chosen = files.orderBy(F.xxhash64(F.regexp_extract("file", "([^/]+/[^/]+/[^/]+)$", 1), F.lit(seed)), "file").offset(start).limit(quant)
        last = F.regexp_extract("source", "([^/]+/[^/]+/[^/]+)$", 1)
        rows = rows.join(chosen.select(F.regexp_extract("file", "([^/]+/[^/]+/[^/]+)$", 1).alias("_file")), last == F.col("_file"), "left_semi")
    project = F.regexp_extract("source", "([^/]+/[^/]+)/[^/]+$", 1)
    return rows.select("*", F.array(project).alias("seen_in"), F.md5("Author").alias("author_hash"), F.try_to_timestamp("Date").alias("utc_datetime"))
