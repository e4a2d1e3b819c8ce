"""Pages of repeated keywords, bare links or product tags instead of text (problem 10).

Two measures of each whole page are combined. One builds the page's suffix automaton over its characters and counts those
that lie in a repeated maximal substring. The other looks for clauses, without a list of words: a segment is a clause if
it is written like one (a capital, words in lower case with plain gaps, a mark at its end), or if it has enough of the
words that the corpus itself uses in such segments and hardly anywhere else. A page is flagged if the characters that are
both repeated and in no clause are a large part of it. Lines in the syntax of code, logs, dependency lists and tables,
which aren't cases, count as structure.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.session import spread

LONGEST_WORD = 40
#: Pages of more characters are measured by a suffix array, which finds the same repeats in less memory.
LONGEST_AUTOMATON = 50_000
#: A clause word stands, of its uses in lower case, this share within a run of words, and this share in lines that have a
#: sentence mark; it has so many uses; at most so many clause words are used, the most frequent ones.
WITHIN, MARKED, LEAST_USES, MOST_WORDS = 0.93, 0.5, 20, 4096
_RUN = re.compile(r"[^\W_]+")
_WORD = re.compile(r"[^\W\d_][\w'’]*")
_LINK = re.compile(r"<a\s[^>]*>|https?://[^\s)\"'<>\]|]+|www\.[^\s)\"'<>\]|]+", re.I)
_SEGMENT = re.compile(r"\n|(?<=[.!?;…])\s|(?<=[。！？；।])|</?(?:li|p|br|ul|ol|td|tr)[^>]*>", re.I)
#: Marks that end a clause, and scripts written without blanks.
_ENDS = re.compile(r"[.!?…:。！？।؟][\"'”»)\]*_`」』]*\s*$")
_UNSPACED = re.compile(r"[\u0e00-\u0eff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]")
_PLAIN_GAP = re.compile(r"(?<=\w)[,;:]? (?=\w)")
#: Lines in the syntax of badges, logs, versions, code and tables.
_STRUCTURE = re.compile(
    r"""^\s*\[?!\[ | ^\s+(?:return\b|\#) | ^\s*(?:\[?\d{4}-\d\d-\d\d[T ]\d\d:\d\d | \[?\d\d:\d\d:\d\d\b | (?:INFO|WARN|ERROR|DEBUG|FATAL)\b | \$\s | [+-]{3}\s | @@ | \#include\b
      | (?:from|import|export|package|use|using|require|return|const|let|var|def|func|fn|class|public|private|static|void|int|if|for|while|else|end|try)\b.*[({;=:'"\[]
      | [})\]];?\s*$ | //|/\*|\*/|<\?php|<!-- )
      | [=~^<>!]=\s*v?\d | [@:=]\s*"?[\^~]?v?\d+\.\d+ | \s v?\d+\.\d+\.\d+\S*\s*(?:\#|$) | [;{]\s*$ | =>|->\s|\(\)|\w\([^)]*\)\s*[;{:]
      | ^\s*[\w.$-]+\s*=\s*\S | ^\s*at\s+\w+\. | ^\s*"[^"]+"\s*: | ^[^|]*\|[^|]*\|.*\d[^|]*\|\s*$""",
    re.X,
)
#: A line with a sentence mark; words, and what may stand before and after a word within a run of words.
_MARK = re.compile(r"[\w`)\"'][.!?…](?:\s|$)")
_ANY_WORD = re.compile(r"[^\W\d_](?:['’]?[^\W\d_])*")
_BEFORE, _AFTER = frozenset(",;:)]`\"”"), frozenset("`([\"“¿")


def repeated_spans(symbols: list[int], weights: list[int], shortest: int) -> int:
    """Weight of the symbols that lie in some substring of at least ``shortest`` symbols which occurs at least twice: one
    suffix automaton, linear in the number of symbols.

    For every prefix the longest suffix that occurs twice is read off the chain of suffix links; the union of these
    maximal repeats is what is covered.
    """
    length, link, go, count, ends, last = [0], [-1], [{}], [0], [], 0
    for c in symbols:
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        count.append(1)
        go.append({})
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = cur
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                count.append(0)
                go.append(go[q].copy())
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        ends.append(cur)
        last = cur
    del go
    buckets = sorted(range(1, len(length)), key=length.__getitem__)
    for s in reversed(buckets):
        if link[s] > 0:
            count[link[s]] += count[s]
    longest = [0] * len(length)
    for s in buckets:
        longest[s] = length[s] if count[s] >= 2 else longest[link[s]]
    return _covered([longest[e] for e in ends], weights, shortest)


def _covered(longest: list[int], weights: list[int], shortest: int) -> int:
    """Weight of the union of the repeats that end at each place and are ``longest`` there."""
    before = [0]
    for w in weights:
        before.append(before[-1] + w)
    covered, reach = 0, len(longest)
    for i in range(len(longest) - 1, -1, -1):
        start = i + 1 - longest[i]
        if longest[i] >= shortest and start < reach:
            covered += before[min(i + 1, reach)] - before[start]
            reach = start
    return covered


def repeated_spans_by_sorting(symbols: list[int], weights: list[int], shortest: int) -> int:
    """``repeated_spans`` by a suffix array of doubled prefixes: the same figure, in a few arrays whatever the length."""
    n = len(symbols)
    rank = np.unique(np.array(symbols, dtype=np.int64), return_inverse=True)[1].astype(np.int64)
    width, order = 1, np.argsort(rank, kind="stable")
    while n > 1:
        key = rank * (n + 1) + np.concatenate([rank[width:] + 1, np.zeros(min(width, n), np.int64)])[:n]
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(key[order]) != 0]))
        width *= 2
        if rank[order[-1]] == n - 1 or width >= n:
            break
    at, follows = rank.tolist(), order.tolist()
    common, h = [0] * n, 0
    for i in range(n):
        if at[i]:
            j = follows[at[i] - 1]
            while i + h < n and j + h < n and symbols[i + h] == symbols[j + h]:
                h += 1
            common[at[i]] = h
            h = max(0, h - 1)
        else:
            h = 0
    before = np.concatenate([[0], np.cumsum(weights)])
    covered = reach = 0
    for i in range(n):
        span = max(common[at[i]], common[at[i] + 1] if at[i] + 1 < n else 0)
        if span >= shortest and i + span > reach:
            covered += int(before[i + span] - before[max(i, reach)])
            reach = i + span
    return covered


def _size(text: str) -> int:
    """Characters of the words and numbers in a text; single characters and runs longer than any word don't count."""
    return sum(len(x) for x in _RUN.findall(text) if (1 < len(x) <= LONGEST_WORD) or _UNSPACED.match(x))


def _visible(text: str) -> int:
    """Characters that aren't blanks."""
    return sum(map(len, text.split()))


def written_clause(segment: str, words: list[str]) -> bool:
    """Whether a segment is written like a clause: in spaced scripts at least five words, the first with a capital (where
    the script has them) and most others in lower case, plain gaps between most of them, a mark at its end, and hardly a word
    twice; in unspaced ones at least eight letters with a mark at the end."""
    if not _ENDS.search(segment):
        return False
    if len(_UNSPACED.findall(segment)) >= 8:
        return True
    if len(words) < 5 or words[0][0].islower() or sum(w[0].isupper() for w in words[1:]) * 2 > len(words):
        return False
    gaps = len(_PLAIN_GAP.findall(segment))
    return gaps >= 0.6 * (len(words) - 1) and segment.count(",") * 3 <= len(words) and len({w.lower() for w in words}) >= 0.75 * len(words)


def parts(text: str, clause_words: frozenset[str]) -> tuple[dict[str, float], list[tuple[str, bool]]]:
    """How the characters of a page's words and links are divided, and its pieces with whether they are loose.

    ``words``; ``clause`` (clauses and links beside them), ``structure`` (code, logs, versions, tables, badges), ``link``
    (links without a clause) and ``free`` (the rest); these four add up to 1, or 0 without any word.
    """
    clause = structure = words = free = link = 0
    pieces: list[tuple[str, bool]] = []
    for line in text.split("\n"):
        if not line or line.isspace():
            continue
        plain = _LINK.sub(" ", line)
        links = len(line) - len(plain)
        if _STRUCTURE.search(plain):
            structure += _size(plain) + links
            words += len(_WORD.findall(plain))
            pieces.append((line, False))
            continue
        within = loose = 0
        for segment in _SEGMENT.split(plain):
            inside = [w for w in _WORD.findall(segment) if len(w) <= LONGEST_WORD]
            words += sum(len(w) > 1 for w in inside)
            size = _size(segment)
            hits = sum(w.lower() in clause_words for w in inside)
            if written_clause(segment, inside) or (len(inside) >= 3 and hits >= max(1 if _ENDS.search(segment) else 2, 0.11 * len(inside))):
                within += size
            else:
                loose += size
        clause += within + (links if within else 0)
        free += loose
        link += 0 if within else links
        pieces.append((line, loose + (0 if within else links) > within))
    total = max(1, clause + structure + free + link)
    return {"words": words, "clause": clause / total, "structure": structure / total, "link": link / total, "free": free / total}, pieces


def coverage(pieces: list[tuple[str, bool]]) -> float:
    """Share of the visible characters of a page that are repeated within it and loose. Repeats count from a length on
    that chance repeats in a page of this size don't reach; case and the width of blanks don't matter."""
    texts = [(re.sub(r"\s+", " ", piece.lower()) + "\n", loose) for piece, loose in pieces]
    symbols = [ord(c) for piece, _ in texts for c in piece]
    weights = [int(loose and not c.isspace()) for piece, loose in texts for c in piece]
    visible = sum(_visible(piece) for piece, _ in texts)
    shortest = max(4, round(len(symbols).bit_length() / 2))
    spans = repeated_spans if len(symbols) <= LONGEST_AUTOMATON else repeated_spans_by_sorting
    return spans(symbols, weights, shortest) / max(1, visible)


#: A page is a keyword page from this share of repeated loose characters on, if it has that many words or is mostly links.
LEAST_COVERAGE, LEAST_WORDS = 0.2, 14


def measures(text: str, clause_words: frozenset[str] = frozenset()) -> dict[str, float]:
    """The shares of ``parts`` and ``repeat``, the share of repeated loose characters.

    The loose characters bound ``repeat``; where they are too few for the decision the automaton isn't built and
    ``repeat`` is 0.
    """
    shares, pieces = parts(text, clause_words)
    visible, loose = _visible(text), sum(_visible(piece) for piece, is_loose in pieces if is_loose)
    return shares | {"repeat": coverage(pieces) if loose >= LEAST_COVERAGE * visible else 0.0}


def is_keyword_page(m: dict[str, float], least_words: int = LEAST_WORDS) -> bool:
    """The decision on the measures of a page: enough words or links, more of them loose than in clauses and structure,
    and enough of the page both repeated and loose."""
    if m["words"] < least_words and m["link"] < 0.5:
        return False
    return m["free"] + m["link"] > 0.5 and m["repeat"] >= LEAST_COVERAGE


def word_uses(text: str) -> tuple[list[str], list[str], list[str]]:
    """The words in lower case of a text: all uses, those within a run of words (a blank, or a mark and a blank, between it
    and a word on either side), and those in lines with a sentence mark."""
    uses: list[str] = []
    inner: list[str] = []
    marked: list[str] = []
    for line in text.split("\n"):
        tokens = line.split()
        last, first = len(tokens) - 1, len(uses)
        for i, token in enumerate(tokens):
            if not token.isalpha():
                words = [w for w in _ANY_WORD.findall(token) if w.islower()]
                uses += words
                if words != [token]:
                    continue
            elif token.islower():
                uses.append(token)
            else:
                continue
            if 0 < i < last:
                before, after = tokens[i - 1][-1], tokens[i + 1][0]
                if (before in _BEFORE or before.isalnum()) and (after in _AFTER or after.isalnum()):
                    inner.append(token)
        if len(uses) > first and _MARK.search(line):
            marked += uses[first:]
    return uses, inner, marked


def clause_words(docs: DataFrame, text_col: str = "text") -> frozenset[str]:
    """The words that the texts of a table use within clauses and hardly anywhere else, whatever the language.

    One pass over all lines, counts per batch, one aggregation; at most ``MOST_WORDS`` words, the most frequent
    ones, reach the driver, and function words are among the most frequent of any language.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            totals = Counter(), Counter(), Counter()
            for text in batch["page"]:
                for counter, words in zip(totals, word_uses(text)):
                    counter.update(words)
            words = list(totals[0])
            yield pd.DataFrame({"word": words} | {name: [c[w] for w in words] for name, c in zip(("n", "inner", "marked"), totals)}).astype({"word": object, "n": "int64", "inner": "int64", "marked": "int64"})

    texts = docs.select(F.col(text_col).cast("string").alias("page")).where("page is not null")
    counts = texts.mapInPandas(count, "word string, n bigint, inner bigint, marked bigint").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("n", "inner", "marked")])
    chosen = counts.where((F.col("n") >= LEAST_USES) & (F.col("inner") >= F.col("n") * WITHIN) & (F.col("marked") >= F.col("n") * MARKED))
    return frozenset(r["word"] for r in chosen.orderBy(F.desc("n"), "word").limit(MOST_WORDS).collect())


def keyword_pages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Flagged pages with their measures: ``id_col``, words, repeat, clause, structure, link.

    Every text is judged on its whole, whatever its kind is said to be; equal texts of a batch are judged once and all
    their ids come out. Clause words are learned from ``docs`` first. Null, empty and blank texts are never flagged. A
    repeated id comes out once for each of its texts; a null id is passed on. Extra columns are not read; no rows give no
    rows.
    """
    source = docs.select(F.col(id_col).alias("page_id"), F.col(text_col).cast("string").alias("page")).where("trim(page) <> ''")
    kind = source.schema["page_id"].dataType.simpleString()
    words = docs.sparkSession.sparkContext.broadcast(clause_words(source, "page"))

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, dict[str, float]] = {}
            out = []
            for page_id, page in zip(batch["page_id"], batch["page"]):
                if page not in seen:
                    seen[page] = measures(page, words.value)
                if is_keyword_page(seen[page]):
                    out.append({"page_id": page_id} | seen[page])
            yield pd.DataFrame(out, columns=["page_id", "words", "repeat", "clause", "structure", "link"]).astype({"words": "int64"})

    fields = "words bigint, repeat double, clause double, structure double, link double"
    return spread(source).mapInPandas(judge, f"page_id {kind}, {fields}").withColumnRenamed("page_id", id_col)
