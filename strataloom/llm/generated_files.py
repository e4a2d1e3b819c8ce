"""Generated, minified, vendored and data files among source files (problem 3).

Only paths and counts are known of a file, so identifiers are what is modelled. How a file was committed says nothing
about its name, and gives weak labels: text that only grows was copied in, large text that is rewritten comes from a
tool, a few lines per commit are minified lines, binary content is data. Over the identifiers of paths are learned, by
counting in Spark,

* a character trigram model of the pieces of hand-written names per language; the cross-entropy of a file's worst piece
  tells mangled names,
* how each identifier template (directories, masked name parts, affixes) behaves; a template that recurs with one
  behaviour, so with low diversity, is a marker of that behaviour,
* the prevailing naming style of each repository; a foreign style, and names that repeat their package, are templates
  too, and mark vendored copies.

No mark is listed: all are learned from the tables, so that a mark in fewer than some dozen files isn't known. Content
that is binary, or that came in one way in more lines than the rewritten files' sizes allow for, is data whatever its name.
Trigrams and templates are counted by hashes of 60 bits, so that different ones don't share a count. Of the templates
only those that can decide about a file, by support and share, reach the driver and are broadcast.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import checkpointed, spread

#: Weak labels, by the way a file was committed.
HAND, GENERATED, COPIED, MINIFIED, DATA = range(5)
LARGE, GROWN, FEW_LINES = 600, 100, 8
#: Content that came in one way is data from so many standard deviations (of logarithms) above the median of rewritten files on.
BULK_DEVIATIONS = 4.0
#: A template marks by itself from the first share on, or from the second one among files that no clear template marks;
#: from the third one, of its own behaviour among those files, if the file behaves alike and isn't just small. Then: the
#: least files behind a template, files that stand for the prior, and standard errors that a share is lowered by.
CLEAR, STRONG, FAIR, SUPPORT, PRIOR, DOUBT = 0.88, 0.75, 0.3, 8, 2.0, 2.0
_SPLIT = re.compile(r"[/\\]+")
_HEX = re.compile(r"(?<![a-z0-9])(?=[a-f]*\d)[0-9a-f]{6,}(?![a-z0-9])")


def key_of(text: str) -> int:
    """Hash of 60 bits, so that three more fit into a bigint."""
    return int.from_bytes(blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big") >> 4


class Table:
    """Figures by key, as sorted arrays; 0 for a key that isn't there."""

    def __init__(self, keys: np.ndarray, *figures: np.ndarray):
        order = np.argsort(keys)
        self.keys = np.append(keys[order].astype(np.int64), np.iinfo(np.int64).max)
        self.figures = [np.append(f[order], f.dtype.type(0)) for f in figures]

    def of(self, wanted: Iterable[int]) -> list[np.ndarray]:
        wanted = np.array(wanted, dtype=np.int64)
        at = np.searchsorted(self.keys, wanted)
        at[self.keys[at] != wanted] = len(self.keys) - 1
        return [f[at] for f in self.figures]


def behaviour(commits, inserts, deletes, binary) -> int | None:
    """Weak label of a file from its counts; None where they are null."""
    if binary == 1:
        return DATA
    if inserts is None or deletes is None:
        return None
    if deletes == 0 and inserts > GROWN:
        return COPIED
    if inserts >= LARGE:
        return GENERATED
    return MINIFIED if inserts < FEW_LINES * max(1, commits or 1) else HAND


def naming_style(stem: str) -> str:
    """snake, kebab, pascal, camel, flat or other."""
    for name, pattern in (("flat", r"[a-z0-9]+"), ("snake", r"[a-z0-9]+(?:_[a-z0-9]+)+"), ("kebab", r"[a-z0-9]+(?:-[a-z0-9]+)+"), ("pascal", r"(?:[A-Z][a-z0-9]*)+"), ("camel", r"[a-z][a-z0-9]*(?:[A-Z][a-z0-9]*)+")):
        if re.fullmatch(pattern, stem):
            return name
    return "other"


def parts_of(path: str) -> tuple[list[str], str, str, str]:
    """Directories, name, stem before the first dot, and language (the last suffix), all but the stem in lower case."""
    *folders, name = _SPLIT.split(path)
    stem = name.split(".")[0]
    lowered = name.lower()
    return [f.lower() for f in folders if f], lowered, stem, lowered.rpartition(".")[2] if "." in lowered else ""


def pieces_of(name: str) -> list[str]:
    """Pieces of a name as spelled, in lower case, without its last suffix: between marks and at a capital after a small letter."""
    own = name.rpartition(".")[0] if "." in name else name
    return [x.lower() for x in re.split(r"[._~-]|(?<=[a-z])(?=[A-Z])", own) if x]


def name_grams(piece: str, language: str) -> Iterator[tuple[int, int]]:
    """Keys of the (trigram, its two-character context) pairs of a piece of a name in a language."""
    padded = f"^^{piece}$"
    for i in range(2, len(padded)):
        yield key_of(f"{language}|{padded[i - 2 : i + 1]}"), key_of(f"{language}|{padded[i - 2 : i]}|")


def templates(path: str, style: str | None, entropy: float, length: int = 0) -> set[str]:
    """Identifier templates of a path: hex runs are H, numbers 9; its naming style and its cross-entropy are templates too."""
    folders, name, stem, language = parts_of(path)
    masked = re.sub(r"\d+", "9", _HEX.sub("H", name))
    pieces = re.split(r"[._~-]", masked)
    found = {f"d:{'@' if f.startswith('@') else f}" for f in folders}
    found |= {f"t:{p}" for p in pieces[:-1]}
    found |= {f"b:{masked}", f"b:{masked.rpartition('.')[0]}", f"x:.{masked.partition('.')[2]}"}
    if (head := re.match(r"[a-z0-9]+[_~-]", masked)) is not None:
        found |= {f"f:{head.group()}", f"f:{head.group()}.{language}"}
    if (tail := re.search(r"[._~-][a-z0-9]+\.[a-z0-9]+$", masked)) is not None:
        found |= {f"l:{tail.group()}", f"fl:{pieces[0]}{tail.group()}"}
    if folders and re.sub(r"[^a-z0-9]", "", folders[-1]) == re.sub(r"[^a-z0-9]", "", stem.lower()):
        found |= {"own:package", f"own:{language}:{'/'.join(folders[:-1][-1:])}"}
    own = naming_style(stem)
    if style and own != style:
        found.add(f"foreign:{own}:{style}:{language}:{'/'.join(folders[:1])}")
    found.add(f"entropy:{language}:{min(20, int(entropy * 2))}:{min(4, length // 4)}")
    return found


def cross_entropy(pieces: list[str], language: str, grams: Table) -> tuple[float, int]:
    """Bits per character of the worst piece of a name under the hand-written names of its language, and its length."""
    pairs = [list(name_grams(piece, language)) for piece in pieces]
    if not pairs:
        return 0.0, 0
    counts = grams.of([x for piece in pairs for pair in piece for x in pair])[0].tolist()
    bits, at = [], 0
    for piece in pairs:
        end = at + 2 * len(piece)
        bits.append(sum(-math.log2((a + 0.05) / (b + 2.0)) for a, b in zip(counts[at:end:2], counts[at + 1 : end : 2])) / len(piece))
        at = end
    worst = max(range(len(bits)), key=bits.__getitem__)
    return bits[worst], len(pieces[worst])


def _counted(keys: list[int] | np.ndarray) -> pd.DataFrame:
    """Keys of a batch with their counts, so that fewer rows are shuffled."""
    key, n = np.unique(np.array(keys, dtype=np.int64), return_counts=True)
    return pd.DataFrame({"key": key, "n": n.astype(np.int64)})


def _unpacked(packed: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All keys of a batch, where each row's begin, and how many it has (at least one)."""
    n = packed.str.len().to_numpy().astype(np.int64) // 8
    return np.frombuffer(b"".join(packed), dtype=np.int64), np.cumsum(n) - n, n


def source_files(totals: DataFrame, commits: DataFrame) -> DataFrame:
    """One row per file of either table: repo, path, commits, inserts, deletes, is_binary.

    A null owner_repo is owner/repo_name. Repeated rows count once; where both tables know a file the larger figure
    holds. Files without path or repository are left out.
    """
    repo = F.coalesce("owner_repo", F.concat_ws("/", "owner", "repo_name")).alias("repo")
    day = commits.select(repo, F.col("file_path").alias("path"), "commit_id", "total_inserts", "total_deletes", "is_binary").distinct()
    from_commits = day.groupBy("repo", "path").agg(F.count("*").alias("commits"), F.sum("total_inserts").alias("inserts"), F.sum("total_deletes").alias("deletes"), F.max("is_binary").alias("is_binary"))
    from_totals = totals.select(repo, F.col("file_path").alias("path"), F.col("num_commits").alias("commits"), F.col("total_inserts").alias("inserts"), F.col("total_deletes").alias("deletes"), "is_binary")
    both = from_commits.unionByName(from_totals).where("repo is not null and path is not null and path <> ''")
    return both.groupBy("repo", "path").agg(*[F.max(c).cast("bigint").alias(c) for c in ("commits", "inserts", "deletes", "is_binary")])


def _first(share: np.ndarray, texts: list[str], least: float) -> int:
    """The template that decides: of those with a sufficient share the cross-entropy, then a foreign style, then the one of
    the greatest share; without any the one of the greatest share."""
    order = [i for prefix in ("entropy:", "foreign:", "own:") for i, t in enumerate(texts) if t.startswith(prefix) and share[i] >= least]
    return order[0] if order else int(share.argmax())


def _plain(value):
    return None if value is None or value != value else int(value)


def machine_made(totals: DataFrame, commits: DataFrame) -> DataFrame:
    """Files that no one wrote by hand for the repository: owner_repo, file_path (as stored), mark, the template that
    decides, and its share.

    ``totals`` has the columns of repo_file, ``commits`` those of file_hacker_commit; other columns aren't read. Null
    counts leave the decision to the name; null is_binary counts as text. Empty tables give no rows. ``mark`` is the
    behaviour that the decisive ``template`` stands for, or ``data`` without template for binary content and one-way bulk.
    """
    files = source_files(totals, commits)

    def styles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"repo": batch["repo"], "style": [naming_style(parts_of(p)[2]) for p in batch["path"]]})

    major = files.select("repo", "path").mapInPandas(styles, "repo string, style string").groupBy("repo", "style").count().groupBy("repo").agg(F.max_by("style", F.struct("count", "style")).alias("style"))
    files = spread(checkpointed(files.join(major, "repo", "left")))
    sc = files.sparkSession.sparkContext

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[int] = []
            for path, n, i, d, b in zip(*(batch[c] for c in ("path", "commits", "inserts", "deletes", "is_binary"))):
                if behaviour(_plain(n), _plain(i), _plain(d), _plain(b)) == HAND:
                    language = parts_of(path)[3]
                    for piece in pieces_of(_SPLIT.split(path)[-1]):
                        for pair in name_grams(piece, language):
                            out.extend(pair)
            yield _counted(out)

    known_grams = files.mapInPandas(grams, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    names = sc.broadcast(Table(known_grams["key"].to_numpy(), known_grams["n"].to_numpy().astype(np.float64)))

    def texts_of(path: str, style: str | None) -> list[str]:
        bits, length = cross_entropy(pieces_of(_SPLIT.split(path)[-1]), parts_of(path)[3], names.value)
        return sorted(templates(path, style, bits, length))

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["keys"] = [np.array([key_of(t) for t in texts_of(p, s)], dtype=np.int64).tobytes() for p, s in zip(batch["path"], batch["style"])]
            label = [behaviour(_plain(n), _plain(i), _plain(d), _plain(b)) for n, i, d, b in zip(batch["commits"], batch["inserts"], batch["deletes"], batch["is_binary"])]
            batch["label"] = [-1 if x is None else x for x in label]
            yield batch[["repo", "path", "inserts", "deletes", "is_binary", "style", "keys", "label"]]

    # every path is parsed once; the passes that follow work on the keys of its templates
    keys_of = checkpointed(files.mapInPandas(keyed, "repo string, path string, inserts bigint, deletes bigint, is_binary bigint, style string, keys binary, label int"))

    def learn(known: Table | None) -> Table:
        """Per template that can decide the share of files that don't behave as hand-written, the share of the commonest
        such behaviour, and that behaviour; files with a template that ``known`` gives a clear share are left out."""
        shared = sc.broadcast(known) if known is not None else None

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keys, starts, n = _unpacked(batch["keys"])
                label = batch["label"].to_numpy().astype(np.int64)
                wanted = label >= 0
                if shared is not None and len(n):
                    wanted &= np.maximum.reduceat(shared.value.of(keys)[0], starts) < CLEAR
                yield _counted((keys << 3 | np.repeat(label, n))[np.repeat(wanted, n)])

        label = F.col("key").bitwiseAND(F.lit(7))
        sums = [F.sum(F.when(label == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(5)]
        table = checkpointed(keys_of.select("keys", "label").mapInPandas(count, "key bigint, n bigint").groupBy(F.shiftright("key", 3).alias("template")).agg(*sums))
        table = table.withColumns({"other": F.expr("n1 + n2 + n3 + n4"), "total": F.expr("n0 + n1 + n2 + n3 + n4"), "top": F.expr("greatest(n1, n2, n3, n4)")})
        table = table.withColumn("kind", F.expr("case top when n1 then 1 when n2 then 2 when n3 then 3 else 4 end"))
        sums_all = table.agg(F.sum("other"), F.sum("total")).first()
        base = (sums_all[0] or 0) / max(1.0, sums_all[1] or 0)

        def lower(part: str, prior: float):
            share = (F.col(part) + PRIOR * prior) / (F.col("total") + PRIOR)
            return share - DOUBT * F.sqrt(F.greatest(share * (1 - share), F.lit(0.01)) / (F.col("total") + PRIOR))

        deciding = table.where(F.col("total") >= SUPPORT).withColumns({"share": lower("other", base), "most": lower("top", 0.0)})
        found = deciding.where((F.col("share") >= STRONG) | (F.col("most") >= FAIR)).select("template", "share", "most", "kind").toArrow()
        figures = [found[c].to_numpy().astype(kind) for c, kind in (("share", np.float64), ("most", np.float64), ("kind", np.int8))]
        return Table(found["template"].to_numpy().astype(np.int64), *figures)

    clear = learn(None)
    models = sc.broadcast((clear, learn(clear)))
    kinds = ["hand", "generated", "vendored", "minified", "data"]
    size = F.percentile_approx(F.log1p("inserts"), [0.5, 0.8413])
    middle, upper = files.where("deletes > 0 and inserts >= 0").agg(size).first()[0] or (math.inf, math.inf)
    bulk = math.expm1(min(700.0, middle + BULK_DEVIATIONS * (upper - middle))) if middle < math.inf else math.inf

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, after = models.value
        for batch in batches:
            keys, starts, n = _unpacked(batch["keys"])
            share, _, kind = first.of(keys)
            rest, rest_most, rest_kind = after.of(keys)
            out = []
            if len(n):
                open_rows = np.maximum.reduceat(share, starts) >= CLEAR
                open_rows |= (np.maximum.reduceat(rest, starts) >= STRONG) | (np.maximum.reduceat(rest_most, starts) >= FAIR)
            for i, (repo, path, inserts, deletes, binary, style, label) in enumerate(zip(*(batch[c] for c in ("repo", "path", "inserts", "deletes", "is_binary", "style", "label")))):
                if open_rows[i]:
                    own = slice(starts[i], starts[i] + n[i])
                    texts = texts_of(path, style)
                    best, second, alike = _first(share[own], texts, CLEAR), _first(rest[own], texts, STRONG), _first(rest_most[own], texts, FAIR)
                    if share[own][best] >= CLEAR:
                        out.append((repo, path, kinds[kind[own][best]], texts[best], float(share[own][best])))
                        continue
                    if rest[own][second] >= STRONG:
                        out.append((repo, path, kinds[rest_kind[own][second]], texts[second], float(rest[own][second])))
                        continue
                    if rest_most[own][alike] >= FAIR and label == rest_kind[own][alike] != MINIFIED:
                        out.append((repo, path, kinds[label], texts[alike], float(rest_most[own][alike])))
                        continue
                if binary == 1 or (deletes == 0 and _plain(inserts) is not None and inserts >= bulk):
                    out.append((repo, path, "data", "", 1.0))
            yield pd.DataFrame(out, columns=["owner_repo", "file_path", "mark", "template", "share"])

    return keys_of.mapInPandas(judge, "owner_repo string, file_path string, mark string, template string, share double")
