"""Results of the text operators that must hold the whole job, not a part of it."""

from strataloom.llm.name_links import fold, name_tokens, same_person


def linked(spark, names):
    return {tuple(r) for r in same_person(spark.createDataFrame(list(enumerate(names)), "id long, name string")).collect()}


def test_short_and_non_latin_names_are_linked(spark):
    groups = [
        ["John Lee <a@x.test>", "Lee, John <b@x.test>", "J. Lee <c@x.test>", "jlee <john.lee@x.test>"],
        ["Robert Wu <d@x.test>", "Wu, Bob <e@x.test>"],
        ["Иван Петров <f@x.test>", "Петров, Иван <g@x.test>", "ИВАН ПЕТРОВ <h@x.test>"],
        ["Γιώργος Παππάς <i@x.test>", "Παππας, Γιωργος <j@x.test>"],
        ["王伟 <k@x.test>", "王伟 <l@x.test>"],
        ["がとう <m@x.test>", "がとう <n@x.test>"],
    ]
    alone = ["John Lea <o@x.test>", "Robert Wi <p@x.test>", "Иван Сидоров <q@x.test>", "王芳 <r@x.test>", "かとう <s@x.test>", "lee <t@x.test>", "abc <u@x.test>"]
    names = [n for g in groups for n in g] + alone
    want = {(names.index(g[0]) + i, names.index(g[0]) + j) for g in groups for j in range(len(g)) for i in range(j)}
    assert linked(spark, names) == want
    assert name_tokens("हिन्दी नाम") == ["हिन्दी", "नाम"] and fold("Й") == "и"


def test_word_orders_meet_whatever_is_known(spark):
    pairs = [["Xaver Huber <a@x.test>", "Huber Xaver <b@x.test>"], ["Mary Ann Orbegozo <c@x.test>", "Orbegozo Mary Ann <d@x.test>"], ["Quentin Smithe <e@x.test>", "Smithe Quentin <f@x.test>", "Smithe, Q. <g@x.test>"]]
    # a family name beyond the share from which tokens are taken as given names
    hot = [f"{a}{b}zor Smithe <h@x.test>" for a in ("Ka", "Bo", "Tu", "Di", "Fe") for b in ("lim", "run", "sed", "gav", "hok", "pyx")]
    names = [n for g in pairs for n in g] + hot
    assert linked(spark, names) == {(0, 1), (2, 3), (4, 5), (4, 6), (5, 6)}


def test_chains_of_slips_end_at_one_spelling(spark):
    families = ["Lipidabo", "Lipidaboxu", "Lipidaboxun", "Lipidaboxuni"]
    families[1:1] = ["Lipidabox"]
    names = [f"Samuel {f} <x@y.test>" for n, f in enumerate(families, 1) for _ in range(n)]
    assert linked(spark, names) == {(i, j) for j in range(len(names)) for i in range(j)}
