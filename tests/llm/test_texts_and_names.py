import random
from collections import Counter

import numpy as np
import pytest

from strataloom.llm.generated_files import Table, cross_entropy, machine_made, name_grams, naming_style, pieces_of, templates
from strataloom.llm.keyword_pages import clause_words, is_keyword_page, keyword_pages, measures, repeated_spans, repeated_spans_by_sorting
from strataloom.llm.name_links import Given, _edit_one, fold, other_given, parse_person, person_members, persons, same_person, short_forms, trie_join, trie_neighbours

SPAM = [
    "buy cheap watches " * 30,
    "\n".join(f"Verge proxy {i} pcs - £{i}.15 backlinks" for i in range(100, 130)),
    "\n".join(f"- [best java rust](https://x{i}.invalid/slots.html)" for i in range(20)),
    " ".join(f"#{a}{b}" for a in ("oak", "elm", "fir", "ash", "bay", "yew") for b in ("price", "loan", "deal", "slots", "stars")),
    "Until May the job ran nightly.\n\n" + "react vue golang cloud " * 20,
]
TEXT = [
    "The parser drops the row twice when the queue is empty, so the counts were off by 755. Most of the time is spent in the cache. " * 5,
    "\n".join(f"2016-01-0{i} 02:18 INFO lock: blame {i}867 done" for i in range(1, 9)) * 3,
    "\n".join(f"oak-{i}.core==4.{i}.3" for i in range(40)),
    "func A(id int64) error {\n\tif id < 3 {\n\t\treturn errX\n\t}\n\treturn nil\n}\n" * 10,
    "## 2.0.1 (May 2020)\n" + "* Removed the slow cursor in scan_agent ([#7](https://f.example/a/b/pull/7))\n" * 10,
    "tags: a, b, c\n\n" + "This change moves the queue out of the module and adds a test for the nested case. " * 6,
    "wip", "", " \n ", "x" * 5000, "-" * 900,
]


#: Prose in languages that the corpus of the tests doesn't have.
PROSE = [
    "Le serveur redémarre chaque nuit parce que la mémoire ne suffit plus. Nous avons déplacé les anciens journaux vers un autre disque, mais la sauvegarde dure toujours trop longtemps. Demain nous essayerons avec une compression plus forte.",
    "Serwer uruchamia się ponownie każdej nocy, ponieważ brakuje pamięci. Przenieśliśmy stare dzienniki na inny dysk, ale kopia zapasowa wciąż trwa zbyt długo. Jutro spróbujemy użyć mocniejszej kompresji.",
    "Сервер перезапускается каждую ночь, потому что не хватает памяти. Мы перенесли старые журналы на другой диск, но резервное копирование всё ещё длится слишком долго. Завтра попробуем более сильное сжатие.",
    "服务器每天晚上都会重新启动，因为内存不足。我们把旧的日志移到了另一个磁盘上，但是备份仍然需要很长时间。明天我们会尝试更强的压缩方法。",
]


@pytest.fixture(scope="module")
def learned(spark):
    return clause_words(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("text", SPAM)
def test_keyword_pages(text, learned):
    assert is_keyword_page(measures(text, learned)) and is_keyword_page(measures(text.upper(), learned))


@pytest.mark.parametrize("text", TEXT + PROSE)
def test_other_pages(text, learned):
    assert not is_keyword_page(measures(text, learned))


@pytest.mark.parametrize("text", SPAM)
def test_without_repeats_no_page_is_flagged(text, learned):
    assert not is_keyword_page(measures(text, learned) | {"repeat": 0.0})


def test_clause_words_are_learned_not_listed(spark):
    lines = [f"Jeg tror at {x} ikke er så god som de andre, men den er ny." for x in ("bilen", "katten", "huset", "båten", "boka", "maten") for _ in range(4)]
    spam = ["billig katt billig hus billig båt " * 20] * 3
    words = clause_words(spark.createDataFrame([(t,) for t in lines + spam + [None, ""]], "text string"))
    assert {"ikke", "er", "som", "men"} <= words and not {"billig", "katt"} & words
    assert clause_words(spark.createDataFrame([], "text string")) == frozenset()


@pytest.mark.parametrize("word", ["", "a", "abc", "abcabc", "aaaa", "abxabyab", "mississippi", "abcdabcexyzxyz"])
@pytest.mark.parametrize("shortest", [1, 2, 3])
def test_repeats_against_brute_force(word, shortest):
    covered = set()
    for i in range(len(word)):
        for j in range(i + shortest, len(word) + 1):
            if sum(word.startswith(word[i:j], k) for k in range(len(word))) > 1:
                covered |= set(range(i, j))
    for spans in (repeated_spans, repeated_spans_by_sorting):
        assert spans([ord(c) for c in word], [1] * len(word), shortest) == len(covered)


def test_both_ways_to_repeats_agree():
    draw = random.Random(3)
    for _ in range(200):
        text = [draw.randrange(3) for _ in range(draw.randrange(40))]
        weights = [draw.randrange(2) for _ in text]
        assert repeated_spans(text, weights, 3) == repeated_spans_by_sorting(text, weights, 3)
    assert repeated_spans_by_sorting([1] * 60_000, [1] * 60_000, 4) == 60_000


def test_page_table(spark):
    rows = [(1, SPAM[0], "x"), (2, SPAM[0], "x"), (2, SPAM[0], "x"), (3, TEXT[0], "x"), (4, None, "x"), (5, "", "x"), (None, SPAM[1], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string")
    assert sorted((r["doc_id"] or 0) for r in keyword_pages(docs).collect()) == [0, 1, 2, 2]
    assert keyword_pages(docs.limit(0)).isEmpty()


def test_name_parsing():
    given = Given({"magdalena", "henrietta"}, {"hettie": "henrietta"})
    cases = {
        "Henrietta Graruvyhy <h@x.test>": ("henrietta", "h", "graruvyhy"),
        "Graruvyhy, Hettie <h@x.test>": ("henrietta", "h", "graruvyhy"),
        "GRARUVYHY H. <hettie.graruvyhy@x.test>": ("henrietta", "h", "graruvyhy"),
        "Dr. Henrietta M. Graruvhy (Acme) <hgraruvyhy@x.test>": ("henrietta", "h", "graruvyhy"),
        "graruvyhy_h <h@x.test>": ("", "h", "graruvyhy"),
        "hgraruvyhy {h@x.test}": ("", "h", "graruvyhy"),
        "hettiegraruvyhy <h@x.test>": ("henrietta", "h", "graruvyhy"),
        "Maxdalena GrÃ©sÃ-s <m@x.test>": ("magdalena", "m", "gresis"),
        "proxy-bot <bot@x.test>": None, "root <root@x.invalid>": None, "<abc@x.test>": None, "Your Name <you@x>": None, "henrietta <h@x>": None, None: None, "": None,
    }
    for alias, want in cases.items():
        assert parse_person(alias, given) == want, alias


def test_trie_walk_against_brute_force():
    names = ["graruvyhy", "graruvhy", "graruvyyh", "grarruvyhy", "xraruvyhy", "rgaruvyhy", "graruv", "abcdef", "abdcef", "abcdefg", "a", "ab", "ba"]
    want = sorted((min(a, b), max(a, b)) for i, a in enumerate(names) for b in names[:i] if _edit_one(a, b))
    assert trie_neighbours(names) == want


def test_persons(spark):
    rows = [(1, "Samuel Lipidabi <sam.lipidabi@x.test>"), (2, "Sam Lipidabi <samuel@desk.invalid>"), (3, "Lipidaabi, Samuel <samuel@desk.invalid>"), (4, "LIPIDABI S. <s@x.test>"), (5, "Susanne Lipidaro <team@x.test>"), (6, "Samuel Orovagus <samuel@desk.invalid>"), (7, "bot <bot@x.test>"), (8, None), (1, "Samuel Lipidabi <sam.lipidabi@x.test>"), (None, "Samuel Lipidabi <x@y>")]
    df = spark.createDataFrame(rows, "id long, name string")
    assert {tuple(r) for r in same_person(df).collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}
    assert persons(df.limit(0)).isEmpty() and same_person(df.limit(0)).isEmpty()
    two = spark.createDataFrame([(1, "Samuel Lipidabi <a@x>"), (2, "Susanne Lipidabi <b@x>"), (3, "S. Lipidabi <c@x>")], "id long, name string")
    assert same_person(two).isEmpty()


def test_short_forms_are_learned_from_addresses(spark):
    assert other_given("Sindre Lipidabo <pim.lipidabo@x.test>") == [("sindre", "pim", "lipidabo")]
    assert other_given("Lipidabo Sindre <pimlipidabo@x.test>") == [("sindre", "pim", "lipidabo")]
    for alias in ("Sindre Lipidabo <team@x.test>", "Sindre Lipidabo <s.lipidabo@x.test>", "Sindr Lipidabo <sindre.lipidabo@x.test>", "Sindre Lipidabo", None):
        assert other_given(alias) == []
    assert short_forms([("pim", "sindre", 4), ("pim", "samson", 1), ("lo", "pim", 3), ("al", "albert", 3), ("al", "alma", 3), ("x", "y", 2)], {"sindre": 9, "samson": 9, "pim": 3, "albert": 5, "alma": 5, "x": 1}, 3) == {"pim": "sindre", "lo": "sindre"}
    families = ("Lipidabo", "Gravuta", "Stomenik")
    rows = [(i, f"Sindre {f} <pim.{f.lower()}@x.test>") for i, f in enumerate(families)] + [(10 + i, f"Pim {f} <{f.lower()}@y.test>") for i, f in enumerate(families)] + [(20, "Samson Lipidabo <pim@x.test>")]
    df = spark.createDataFrame(rows, "id long, name string")
    assert {tuple(r) for r in same_person(df).collect()} == {(i, 10 + i) for i in range(3)}
    assert {tuple(r) for r in person_members(df).collect()} == {(i % 10, i) for i in (0, 1, 2, 10, 11, 12)} | {(20, 20)}


def test_every_slip_meets_in_a_shard(spark):
    draw = random.Random(5)
    words = {"".join(draw.choice("abc") for _ in range(draw.randrange(3, 10))) for _ in range(150)}
    words |= {w[:i] + w[i + 1] + w[i] + w[i + 2 :] for w in list(words)[:60] for i in range(len(w) - 1)} | {w[:i] + w[i + 1 :] for w in list(words)[:40] for i in range(len(w))}
    words = sorted(w for w in words if len(w) >= 3)
    got = {(r["left_family"], r["right_family"]) for r in trie_join(spark.createDataFrame([("g", w) for w in words], "given string, family string")).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and _edit_one(a, b)}


def test_folding():
    assert fold("StÃ¼tÃ¡grÃ©") == "stutagre" and fold("Ünö") == "uno" and fold("Ãx") == "ax"


def test_file_templates():
    assert {"d:node_modules", "b:index.js"} <= templates("a/node_modules/index.js", None, 1.0)
    assert {"x:.H.js", "t:app"} <= templates("public/app.9c426eb0.js", "snake", 3.0)
    assert [naming_style(x) for x in ("a_b", "a-b", "AbC", "aB", "ab", "a.b!")] == ["snake", "kebab", "pascal", "camel", "flat", "other"]
    assert pieces_of("OakHub.min.4.js") == ["oak", "hub", "min", "4"] and pieces_of("Makefile") == ["makefile"] and pieces_of(".js") == []


def test_mangled_names_have_a_high_cross_entropy():
    counts = Counter(key for name in ("parser", "server", "cursor", "loader", "session") * 20 for pair in name_grams(name, "js") for key in pair)
    grams = Table(np.array(list(counts), dtype=np.int64), np.array(list(counts.values()), dtype=np.float64))
    known, worst = cross_entropy(["server", "parser"], "js", grams), cross_entropy(["server", "9c426eb0"], "js", grams)
    assert known[0] < 1 < 3 < worst[0] and worst[1] == 8
    assert cross_entropy([], "js", grams) == (0.0, 0)


def test_machine_made_files(spark):
    totals = "owner string, repo_name string, owner_repo string, file_path string, num_commits long, total_inserts long, total_deletes long, is_binary byte"
    commits = "owner string, repo_name string, owner_repo string, file_path string, commit_id string, total_inserts long, total_deletes long, is_binary byte"
    words = [a + b for a in ("oak", "map", "log", "rpc", "sdk", "dns", "hub", "kit") for b in ("er", "let", "ling", "ing", "s", "box", "way", "core")]
    files = [(f"src/{w}/{v}_{w}.py", 5, 120, 40, 0) for w, v in zip(words, words[5:] + words[:5])] + [(f"lib/{w}_{v}.js", 6, 90 + i, 30, 0) for i, (w, v) in enumerate(zip(words, words[::-1]))]
    files += [x for w in words for x in ((f"web/node_modules/{w}/{w}.js", 1, 900, 0, 0), (f"api/{w}_pb2.py", 3, 4000, 2000, 0), (f"js/{w}.min.js", 4, 12, 9, 0))]
    marked = [("web/node_modules/new/new.js", None, None, None, None), ("api/new_pb2.py", None, None, None, 0), ("js/new.min.js", 4, None, 9, 0)]
    # content tells: binary, or more lines at once than any rewritten file
    content = [("src/blob.c", 1, 0, 0, 1), ("src/big.py", 1, 90000000, 0, 0)]
    hand = [("src/new/hubing_dnsway.py", 5, 120, 40, None), ("lib/rpcs_oakbox.js", 6, 90, 30, 0), ("src/maps_dnser.py", 1, 40, 0, 0)]
    t = spark.createDataFrame([("o", "r", "o/r", *f) for f in files + marked + content + hand] + [("o", "r", "o/r", None, 1, 1, 1, 0)], totals)
    c = spark.createDataFrame([("o", "r", None, "web/node_modules/z/z.js", "c1", 300, 0, None)] * 2 + [("o", "r", "o/r", "src/maps_dnser.py", "c2", 3, 1, 0)], commits)
    got = {r["file_path"]: r["mark"] for r in machine_made(t, c).collect()}
    assert {p for p, *_ in marked + content} | {"web/node_modules/z/z.js"} <= set(got)
    assert not {p for p, *_ in hand} & set(got) and not any(p.startswith(("src/", "lib/")) for p in got if p not in {x for x, *_ in content})
    assert sum(p.startswith(("web/", "api/", "js/")) for p in got) == 3 * len(words) + 4
    assert machine_made(t.limit(0), c.limit(0)).isEmpty()
