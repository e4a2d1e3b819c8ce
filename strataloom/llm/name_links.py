"""Variant spellings of one person's name (problem 7).

A name is folded (encoding slips undone, accents and case dropped), stripped of titles and remarks, and split into a
given part and a family part whatever their order. Equal families are one key; families that differ by a typing slip are
found by a trie join: the family names of each given name are sharded by their first and by their last letters, each
shard is a trie, and every name walks it as a Levenshtein automaton of distance 1; slips of given names are looked up in a
trie alike. The order of tokens is guessed by the given names that the whole table knows; names that meet in the sorted set
of their tokens then get one order. Short forms of given names are learned from the table: an address that spells the family
name of its display name beside another given name is evidence, and so is an address of two display names of one family.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.llm.clusters import boruvka
from strataloom.session import checkpointed, parallelism

#: Everyday English short forms, for tables too small to learn from; what a table tells goes before.
NICKNAMES = {
    "alex": "alexander", "andy": "andrew", "ben": "benjamin", "bill": "william", "bob": "robert", "chris": "christopher", "dan": "daniel", "dave": "david", "ed": "edward", "fred": "frederick",
    "greg": "gregory", "jim": "james", "joe": "joseph", "jon": "jonathan", "ken": "kenneth", "liz": "elizabeth", "matt": "matthew", "meg": "margaret", "mike": "michael", "nick": "nicholas",
    "pete": "peter", "phil": "philip", "rob": "robert", "ron": "ronald", "sam": "samuel", "steve": "stephen", "sue": "susan", "ted": "theodore", "tim": "timothy", "tom": "thomas", "tony": "anthony", "will": "william",
}
#: Words that show an account to be no person's.
NO_PERSON = frozenset("bot release noreply mirror admin root user ubuntu team ci build builder jenkins system daemon service automation robot deploy github gitlab dependabot unknown nobody anonymous localhost test your".split())
TITLES = frozenset("dr mr mrs ms prof dipl ing sir".split())
#: Family names with fewer letters are linked by equal spelling alone, and read from a handle only if the address tells both names.
LEAST_FAMILY = 4
#: A given name that is so many times rarer than one a slip away is a slip itself.
SLIP_RATIO = 10
#: Scripts with case or accents to fold, and scripts whose names are written without spaces and in single letters.
FOLDED, UNSPACED = ("LATIN", "GREEK", "CYRILLIC"), ("CJK", "HANGUL", "HIRAGANA", "KATAKANA")
_LETTERS = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case without accents; text that was read in the wrong encoding is read again first."""
    if re.search("[ÃÂÄÅ]", text):
        # a soft hyphen within a slip is often shown as a plain one
        mended = text.replace("Ã-", "Ã­")
        for wrong in ("latin-1", "cp1252"):
            try:
                text = mended.encode(wrong).decode("utf-8")
                break
            except UnicodeError:
                continue
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("ø", "o").replace("ł", "l"))
    if text.isascii():
        return text.lower()
    out, plain = [], True
    for c in text:
        if not unicodedata.combining(c):
            plain = c.isascii() or _script(c) in FOLDED
        elif plain:
            continue
        out.append(c)
    # marks that tell letters apart, as in kana, are put back
    return unicodedata.normalize("NFC", "".join(out)).lower()


@lru_cache(100_000)
def _script(c: str) -> str:
    return unicodedata.name(c, "").partition(" ")[0]


def _unspaced(token: str) -> bool:
    return _script(token[0]) in UNSPACED


def _initial(token: str) -> bool:
    """Whether a token is an initial; a single letter of an unspaced script is a name."""
    return len(token) == 1 and not _unspaced(token)


def _tokens(folded: str) -> list[str]:
    """Runs of letters, digits and the marks that belong to them, of any script."""
    if folded.isascii():
        return re.findall(r"[a-z0-9]+", folded)
    return "".join(c if c.isalnum() or unicodedata.category(c)[0] == "M" else " " for c in folded).split()


def split_alias(alias: str | None) -> tuple[str, str]:
    """Display name and address of ``Name <address>`` or ``name {address}``; the address is in lower case, '' if absent."""
    if not alias:
        return "", ""
    found = re.match(r"^(.*?)\s*[<{]([^<>{}]*)[>}]\s*$", alias, re.S)
    return (found.group(1), found.group(2).strip().lower()) if found else (alias, "")


def name_tokens(display: str) -> list[str]:
    """Folded tokens of a display name in its order; remarks in brackets, ``via ...`` and titles are dropped, and a
    family name before a comma comes last."""
    display = re.sub(r"\([^)]*\)|\[[^\]]*\]|\bvia\s.*$", " ", display)
    folded = fold(display)
    if "," in folded:
        family, _, rest = folded.partition(",")
        folded = f"{rest} {family}"
    tokens = [t for t in _tokens(folded.replace("'", "")) if t not in TITLES]
    if len(tokens) == 1 and _script(tokens[0][0]) in ("CJK", "HANGUL") and len(tokens[0]) > 1:
        # unspaced: the family name comes first, of one letter in names of up to three
        cut = 1 if len(tokens[0]) <= 3 else 2
        tokens = [tokens[0][cut:], tokens[0][:cut]]
    return tokens


def _edit_one(a: str, b: str) -> bool:
    """Whether two different strings are one insertion, deletion, substitution or swap of neighbours apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i:] == b[i + 1 :] or a[i + 1 :] == b[i:] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])


class Trie:
    """Words in a trie, walked as Levenshtein automata of distance 1 (a swap of neighbours is one slip)."""

    def __init__(self, words: Iterable[str]):
        self.root: dict = {}
        for word in words:
            node = self.root
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word

    def near(self, word: str) -> set[str]:
        """The words at most one slip from ``word``, itself included. The automaton has a state without error, which follows
        the word's letters down the trie, and branches from it into the state with one, which follows the rest exactly."""
        found: set[str] = set()
        n, node, i = len(word), self.root, 0

        def rest(node: dict | None, i: int) -> None:
            while node is not None and i < n:
                node = node.get(word[i])
                i += 1
            if node is not None and "" in node:
                found.add(node[""])

        while node is not None:
            for c, child in node.items():
                if c:
                    rest(child, i)
                    if i < n and c != word[i]:
                        rest(child, i + 1)
            if i == n:
                rest(node, n)
                break
            rest(node, i + 1)
            if i + 1 < n and (swapped := node.get(word[i + 1])) is not None:
                rest(swapped.get(word[i]), i + 2)
            node = node.get(word[i])
            i += 1
        return found


class Given:
    """The given names that a table knows: frequent tokens, short forms with their full ones, and slips of them."""

    def __init__(self, known: set[str], nicknames: dict[str, str] | None = None):
        self.short = NICKNAMES if nicknames is None else nicknames
        self.known = known | set(self.short) | set(self.short.values())
        self.shorts: dict[str, list[str]] = {}
        for short, full in self.short.items():
            self.shorts.setdefault(full, []).append(short)
        self.trie = Trie(g for g in self.known if len(g) >= 4)
        self.seen: dict[str, str | None] = {}

    def full(self, token: str) -> str | None:
        """The full form of a given name or of a slip of one; None if the token is none."""
        if token not in self.seen:
            if token in self.known:
                self.seen[token] = self.short.get(token, token)
            else:
                near = {self.short.get(g, g) for g in self.trie.near(token)} if len(token) >= 4 else set()
                self.seen[token] = near.pop() if len(near) == 1 else None
            if len(self.seen) > 200_000:
                self.seen = {}
                return self.full(token)
        return self.seen[token]

    def prefix(self, text: str) -> tuple[str, str] | None:
        """(full given name, rest) if the text begins with a given name and leaves a family name; the longest wins."""
        for n in range(len(text) - LEAST_FAMILY, 2, -1):
            if text[:n] in self.known:
                return self.short.get(text[:n], text[:n]), text[n:]
        return None

    def initials(self, full: str) -> set[str]:
        """Initials that stand for a given name: its own and those of its short forms."""
        return {full[0], *(x[0] for x in self.shorts.get(full, ()))}


def parse_person(alias: str | None, given: Given) -> tuple[str, str, str] | None:
    """(given, initial, family) of an alias; ``given`` is '' if only an initial is told. None for no person.

    The display name decides. Its handles (first.last, last_f, flast, firstlast) are cut by the known given names; the
    local part of the address fills in a missing given name and mends a slip in the family name if it holds a family
    name one slip away.
    """
    display, address = split_alias(alias)
    tokens = name_tokens(display)
    if not tokens or any(t in NO_PERSON for t in tokens):
        return None
    local, _, domain = address.partition("@")
    local = re.sub(r"^\d+\+", "", fold(local))
    pieces = _LETTERS.findall(re.sub(r"\d+$", "", local))
    mentioned = _family_in(pieces, given)
    if len(tokens) == 1:
        token = re.sub(r"\d+", "", tokens[0])
        apart = [(given.full(a) or a, b) for a, b in (pieces, pieces[::-1])] if len(pieces) == 2 else []
        if (told := next((x for x in mentioned + apart if len(x[0]) > 1 and len(x[1]) < LEAST_FAMILY and token in _handles(*x, given)), None)) is not None:
            first, family = told
        elif token and _unspaced(token):
            # not to be cut into two names: linked by equal spelling
            first, family = token, token
        elif len(token) < LEAST_FAMILY + 1:
            return None
        elif (cut := given.prefix(token)) is not None:
            first, family = cut
        elif given.full(token) is not None:
            return None
        else:
            first, family = token[0], token[1:]
    else:
        tokens = [t for t in tokens if not t.isdigit()] or tokens
        words = [t for t in tokens if not _initial(t)]
        initials = [t for t in tokens if _initial(t)]
        if not words:
            return None
        firsts = [t for t in words if given.full(t) is not None]
        exact = [t for t in firsts if t in given.known]
        first = (exact or firsts or [""])[0]
        rest = [t for t in words if t != first]
        if not rest:
            return None
        if first == "":
            if len(words) == 1 and initials:
                first, rest = initials[0], words
            elif len(words) > 1:
                first, rest = words[0], words[1:]
            else:
                return None
        family = "".join(rest)
    if _initial(first):
        initial, full = first, ""
        for guess, name in mentioned:
            if len(guess) > 1 and (name == family or _slip(name, family)) and initial in given.initials(guess):
                full = guess
        if not full and len(pieces) == 1 and given.full(pieces[0]) and pieces[0] in given.known and given.full(pieces[0])[0] == initial:
            full = given.full(pieces[0])
    else:
        full = given.full(first) or first
        initial = full[0]
    if all(name != family for _, name in mentioned):
        family = next((name for guess, name in mentioned if _slip(name, family) and (not guess or guess == full or guess in given.initials(full) | {initial})), family)
    return full, initial, family


def _slip(a: str, b: str) -> bool:
    """Whether two family names are a typing slip apart; short ones never are."""
    return min(len(a), len(b)) >= LEAST_FAMILY and _edit_one(a, b)


def _handles(first: str, family: str, given: Given) -> tuple[str, ...]:
    firsts = [first, first[0], *(x for k in given.shorts.get(first, ()) for x in (k, k[0]))]
    return tuple(x for f in firsts for x in (f + family, family + f))


def _family_in(pieces: list[str], given: Given) -> list[tuple[str, str]]:
    """Readings of the local part of an address as (given name, its initial or '', family name)."""
    out = []
    if len(pieces) >= 2:
        for a, b in ((pieces[0], pieces[-1]), (pieces[-1], pieces[0])):
            if (full := given.full(a)) is not None and a in given.known:
                out.append((full, b))
            elif len(a) == 1:
                out.append((a, b))
    elif pieces:
        if (cut := given.prefix(pieces[0])) is not None:
            out.append(cut)
        out += [(pieces[0][0], pieces[0][1:]), ("", pieces[0])]
    # of short names only those written apart
    return [(g, f) for g, f in out if len(f) >= (2 if len(pieces) >= 2 else LEAST_FAMILY)]


def address_letters(alias: str | None) -> str:
    """Letters of an address before its @; they confirm the family name that they spell."""
    return "".join(_LETTERS.findall(fold(split_alias(alias)[1].partition("@")[0])))


def token_set(alias: str | None, given: Given) -> str:
    """Words of a display name in alphabetical order, short forms in full, initials left out; '' of less than two."""
    words = {given.short.get(t, t) for t in name_tokens(split_alias(alias)[0]) if not _initial(t) and not t.isdigit()}
    return " ".join(sorted(words)) if len(words) > 1 else ""


def one_order(parsed: DataFrame) -> DataFrame:
    """``parsed`` with one (given, family) for all names whose words are permutations of each other: the one
    whose family name most aliases have. Only names read with different given names are turned; those read alike keep their family names."""
    families = parsed.groupBy("family").agg(F.count("*").alias("n"))
    keys = parsed.where("given <> '' and tokens <> ''").select("tokens", "given", "family").distinct().join(families, "family")
    best = keys.groupBy("tokens").agg(F.max_by(F.struct("given", "family"), F.struct("n", "given", "family")).alias("best"), F.min("given").alias("low"), F.max("given").alias("high")).where("low <> high")
    ends = keys.join(best, "tokens").where("given <> best.given").select(F.concat_ws(" ", "given", "family").alias("a"), F.concat_ws(" ", "best.given", "best.family").alias("b"))
    edges = checkpointed(ends.select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), F.lit(0.0).alias("weight")))
    if edges.isEmpty():
        return parsed
    _, labels = boruvka(edges)
    nodes = parsed.where("given <> ''").select("given", "family").distinct().join(families, "family").join(labels, F.concat_ws(" ", "given", "family") == F.col("node"))
    to = nodes.groupBy("root").agg(F.max_by(F.struct("given", "family"), F.struct("n", "given", "family")).alias("to"))
    turned = nodes.join(to, "root").select("given", "family", "to")
    names = [F.coalesce(f"to.{c}", c).alias(c) for c in ("given", "family")]
    rows = parsed.join(turned, ["given", "family"], "left").select("alias_id", *names, F.when(F.col("to").isNull(), F.col("initial")).otherwise(F.substring("to.given", 1, 1)).alias("initial"), "letters", "tokens")
    return checkpointed(rows)


def other_given(alias: str | None) -> list[tuple[str, str, str]]:
    """Evidence of a short form in one alias: (a given name of the display name, another one that the address has in its
    place, the family name that both spell)."""
    display, address = split_alias(alias)
    words = [t for t in name_tokens(display) if len(t) >= 2 and t.isalpha()]
    local = re.sub(r"^\d+\+", "", fold(address.partition("@")[0]))
    pieces = _LETTERS.findall(re.sub(r"\d+$", "", local))
    out = []
    if len(words) == 2 and not NO_PERSON & {*words, *pieces}:
        for own, family in (words, words[::-1]):
            if len(family) < LEAST_FAMILY:
                continue
            if len(pieces) == 2 and family in pieces:
                other = pieces[1 - pieces.index(family)]
            elif len(pieces) == 1 and pieces[0] != family and pieces[0].endswith(family):
                other = pieces[0][: -len(family)]
            else:
                continue
            if len(other) >= 2 and other != own and not _edit_one(other, own):
                out.append((own, other, family))
    return out


def short_forms(evidence: list[tuple[str, str, int]], uses: dict[str, int], least: int, clear: float = 0.75) -> dict[str, str]:
    """Short form -> full form from (one name, another name, families that show both).

    Of two names the one with more ``uses`` in the table is the full one, the longer one in a tie. A short form belongs to
    the full form of most of its families; if fewer than the share ``clear`` of them agree it is left alone, as it may
    stand for several names. Chains are followed to their end.
    """
    support: dict[str, dict[str, int]] = {}
    for a, b, n in evidence:
        full, short = sorted((a, b), key=lambda x: (-uses.get(x, 0), -len(x), x))
        support.setdefault(short, {})[full] = support.get(short, {}).get(full, 0) + n
    best = {}
    for short, fulls in support.items():
        full = max(fulls, key=lambda x: (fulls[x], x))
        if fulls[full] >= least and fulls[full] >= clear * sum(fulls.values()):
            best[short] = full
    out = {}
    for short in best:
        full, passed = best[short], {short}
        while full in best and full not in passed:
            passed.add(full)
            full = best[full]
        out[short] = full
    return out


def trie_neighbours(names: list[str]) -> list[tuple[str, str]]:
    """Pairs (a, b), a < b, of different names at most one slip (insertion, deletion, substitution, swap) apart: the
    names form one trie, and each walks it."""
    trie = Trie(names)
    return sorted({(name, other) for name in names for other in trie.near(name) if name < other})


def trie_join(keys: DataFrame) -> DataFrame:
    """Pairs of family names of one given name that are one slip apart: given, left_family, right_family.

    ``keys`` has the distinct columns given, family. One slip in a name of at least 2e + 1 letters leaves its first e or its
    last e letters as they are, so that each pair meets in a shard by its first or its last letters. e is 3 from seven
    letters on, 2 from five to seven and 1 up to five, so that names of neighbouring lengths share one e.
    """
    n = F.length("family")
    sharded = keys.select("given", "family", F.explode(F.array_compact(F.flatten(F.array(*[
        F.when(fits, F.array(F.concat(F.lit(f"{e}<"), F.substring("family", 1, e)), F.concat(F.lit(f"{e}>"), F.expr(f"right(family, {e})")))).otherwise(F.array(F.lit(None).cast("string")))
        for e, fits in ((3, n >= 7), (2, n.between(5, 7)), (1, n <= 5))
    ]))) ).alias("shard"))

    def join(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, names = None, []
        for batch in batches:
            out: list[tuple[str, str, str]] = []
            for given, shard, family in zip(batch["given"], batch["shard"], batch["family"]):
                if (given, shard) != at:
                    out += [(at[0], a, b) for a, b in trie_neighbours(names)] if len(names) > 1 else []
                    at, names = (given, shard), []
                names.append(family)
            yield pd.DataFrame(out, columns=["given", "left_family", "right_family"], dtype=object)
        if len(names) > 1:
            yield pd.DataFrame([(at[0], a, b) for a, b in trie_neighbours(names)], columns=["given", "left_family", "right_family"], dtype=object)

    # the shards of a partition come one behind the other; a stated number of partitions, as they are few bytes but much work
    dealt = sharded.repartition(2 * parallelism(keys.sparkSession), "given", "shard").sortWithinPartitions("given", "shard")
    return dealt.mapInPandas(join, "given string, left_family string, right_family string").distinct()


def persons(aliases: DataFrame, id_col: str = "id", name_col: str = "name", least_count: int = 20, least_families: int = 3, most_names: int = 200_000) -> DataFrame:
    """The person of each alias: alias_id, given, family; aliases of one person have equal values.

    Aliases that name no person, null and empty names, names of one given name and null ids give no rows. A family name
    that its own addresses spell is taken as typed; one that isn't joins the commonest such name one slip away. A name
    with an initial alone joins the one person of that initial and family name, if there is just one; else it is a person
    of its own under the initial. Names are words of any script; family names of less than ``LEAST_FAMILY`` letters are
    compared by equal spelling only. A Chinese or Korean name without a space is cut after its family name of one letter
    (two in names of four letters or more), another unspaced one is compared as a whole. Repeated rows count once; an id with two names has both. Extra columns aren't read.

    Tokens of at least ``least_count`` names that aren't mostly the last word are taken as given names, and two given names
    as short and full form if ``least_families`` family names show both; at most ``most_names`` of either are used, the
    most frequent ones. They cut handles and choose an order; names of the same words are one person's in any
    order, however rare. A name in the other order that also has a slip meets only if its given name is known.
    """
    rows = aliases.select(F.col(id_col).cast("bigint").alias("alias_id"), F.col(name_col).cast("string").alias("alias")).where("alias_id is not null and alias is not null").distinct()
    rows = rows.repartition(2 * parallelism(aliases.sparkSession))
    spark = aliases.sparkSession

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for alias in batch["alias"]:
                words = name_tokens(split_alias(alias)[0])
                out += [(t, None, None, int(len(words) > 1 and t == words[-1])) for t in dict.fromkeys(words) if len(t) > 1 and t.isalpha() and not _unspaced(t)]
                out += [(*sorted((a, b)), family, None) for a, b, family in other_given(alias)]
            yield pd.DataFrame(out, columns=["token", "other", "family", "last"]).astype({"last": "Int32"})

    told = checkpointed(rows.select("alias").mapInPandas(tokens, "token string, other string, family string, last int"))
    counts = told.where("other is null").groupBy("token").agg(F.count("*").alias("n"), F.sum("last").alias("last"))
    frequent = counts.where((F.col("n") >= least_count) & (F.col("last") * 2 <= F.col("n")) & (F.length("token") > 2)).orderBy(F.desc("n"), "token").limit(most_names)
    # a token one slip from another that is so much commoner is a slip of it
    frequent = checkpointed(frequent)
    near = trie_join(frequent.where(F.length("token") >= LEAST_FAMILY).select(F.lit("").alias("given"), F.col("token").alias("family"))).select(F.explode(F.array(F.struct(F.col("left_family").alias("token"), F.col("right_family").alias("right")), F.struct(F.col("right_family").alias("token"), F.col("left_family").alias("right")))).alias("p")).select("p.*")
    sizes = frequent.select("token", "n")
    slips = near.join(sizes, "token").join(sizes.select(F.col("token").alias("right"), F.col("n").alias("m")), "right").where(F.col("n") * SLIP_RATIO <= F.col("m"))
    frequent = frequent.join(slips.select("token").distinct(), "token", "left_anti")
    # each family's evidence counts once, so that one person with many aliases makes no short form
    shown = told.where("other is not null").select("token", "other", "family").distinct().groupBy("token", "other").agg(F.count("*").alias("families"))
    shown = shown.where(F.col("families") >= least_families).orderBy(F.desc("families"), "token", "other").limit(most_names)
    uses = counts.select("token", F.col("n").alias("uses"))
    shown = shown.join(uses, "token", "left").join(uses.select(F.col("token").alias("other"), F.col("uses").alias("other_uses")), "other", "left").collect()
    learned = short_forms([(r["token"], r["other"], r["families"]) for r in shown], {name: n or 0 for r in shown for name, n in ((r["token"], r["uses"]), (r["other"], r["other_uses"]))}, least_families)
    names = {r["token"] for r in frequent.collect()} - NO_PERSON
    # an everyday form that the table lacks but that begins like one of its names would make slips of that name ambiguous
    begun = {name[:4] for name in names}
    seeds = {short: learned.get(full, full) for short, full in NICKNAMES.items() if short not in learned and learned.get(full, full) != short and (full in names or full[:4] not in begun)}
    known = spark.sparkContext.broadcast((names, seeds | learned))

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = Given(*known.value)
        for batch in batches:
            out = []
            for alias_id, alias in zip(batch["alias_id"], batch["alias"]):
                if (person := parse_person(alias, given)) is not None:
                    out.append((alias_id, *person, address_letters(alias), token_set(alias, given)))
            yield pd.DataFrame(out, columns=["alias_id", "given", "initial", "family", "letters", "tokens"])

    parsed = one_order(checkpointed(rows.mapInPandas(parse, "alias_id bigint, given string, initial string, family string, letters string, tokens string")))
    full = parsed.where("given <> ''").groupBy("given", "family").agg(F.max(F.expr("contains(letters, family)")).alias("sure"), F.count("*").alias("n"))
    pairs = trie_join(full.select("given", "family").where(F.length("family") >= LEAST_FAMILY))
    both = pairs.unionByName(pairs.select("given", F.col("right_family").alias("left_family"), F.col("left_family").alias("right_family")))
    here = full.select("given", F.col("family").alias("left_family"), F.col("sure").alias("l_sure"), F.col("n").alias("l_n"))
    there = full.select("given", F.col("family").alias("right_family"), F.col("sure").alias("r_sure"), F.col("n").alias("r_n"))
    # an unsure spelling goes to a sure one, or among unsure ones to the commoner, the earlier in a tie
    better = F.expr("not l_sure and (r_sure or r_n > l_n or (r_n = l_n and right_family < left_family))")
    mended = both.join(here, ["given", "left_family"]).join(there, ["given", "right_family"]).where(better)
    mended = mended.groupBy("given", "left_family").agg(F.max_by("right_family", F.struct("r_sure", "r_n", "right_family")).alias("right_family"))
    mended = _followed(mended.select("given", F.col("left_family").alias("family"), F.col("right_family").alias("mended")))
    named = parsed.where("given <> ''").join(mended, ["given", "family"], "left").select("alias_id", "given", F.coalesce("mended", "family").alias("family"))
    owners = named.select("given", "family").distinct().select(F.explode(_initials(F.col("given"))).alias("initial"), "family", "given").groupBy("initial", "family").agg(F.min("given").alias("given"), F.max("given").alias("other"))
    owners = owners.where("given = other").drop("other")
    lone = parsed.where("given = ''").join(owners.withColumnRenamed("given", "owner"), ["initial", "family"], "left")
    return named.unionByName(lone.select("alias_id", F.coalesce("owner", F.concat("initial", F.lit("."))).alias("given"), "family")).distinct()


def _followed(mended: DataFrame) -> DataFrame:
    """given, family, mended with each target that is itself mended followed to its end: pointers jump. Targets are
    always better than what they mend, so there are no circles."""
    mended = checkpointed(mended)
    while True:
        step = mended.select("given", F.col("family").alias("mended"), F.col("mended").alias("further"))
        jumped = checkpointed(mended.join(step, ["given", "mended"], "left").select("given", "family", F.coalesce("further", "mended").alias("mended"), F.col("further").isNotNull().alias("moved")))
        mended = jumped.select("given", "family", "mended")
        if jumped.where("moved").isEmpty():
            return mended


def _initials(given):
    return F.array_distinct(F.array(F.substring(given, 1, 1)))


def person_members(aliases: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """The main result: each alias with its person, named by the smallest id: person_id, alias_id. An alias alone is a
    person of its own; nothing is paired, however many aliases a person has."""
    who = checkpointed(persons(aliases, id_col, name_col))
    return who.join(who.groupBy("given", "family").agg(F.min("alias_id").alias("person_id")), ["given", "family"]).select("person_id", "alias_id").distinct()


def same_person(aliases: DataFrame, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """Every pair of different ids of one person, smaller first: left_alias_id, right_alias_id."""
    who = checkpointed(persons(aliases, id_col, name_col))
    left = who.select(F.col("alias_id").alias("left_alias_id"), "given", "family")
    right = who.select(F.col("alias_id").alias("right_alias_id"), "given", "family")
    return left.join(right, ["given", "family"]).where("left_alias_id < right_alias_id").select("left_alias_id", "right_alias_id").distinct()
