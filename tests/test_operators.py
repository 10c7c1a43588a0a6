from __future__ import annotations

import random

from pyspark.sql import functions as F

from spanforge.functions import vocabulary as V
from spanforge.operators import labels as L
from spanforge.operators import markdown as M
from spanforge.operators import payload as Y
from spanforge.operators import relations as R
from spanforge.operators import segment as S
from spanforge.operators.lines import lines

O, O_, D, B, P, M_ = V.ORG, V.ORG_STAR, V.TITLE, V.BODY, V.PARAGRAPH, V.MARKER


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def spans(spark, labels, texts=None):
    rows, at = [], 0
    for i, label in enumerate(labels):
        text = (texts or labels)[i]
        rows.append((0, i + 1, label, text, at, at + len(text)))
        at += len(text) + 1
    return spark.createDataFrame(rows, "doc_id long, seq int, label string, text string, start long, end long")


def text_of(rows):
    return rows.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(F.struct("seq", "text")))["text"], " ").alias("text"))


def labelled(spark, text):
    return [(r.label, r.start, r.end) for r in L.label(docs(spark, text)).orderBy("start").collect()]


def test_line_offsets_are_code_points(spark):
    got = [(r.line_no, r.start, r.end) for r in lines(docs(spark, "é😀\n\nb")).orderBy("line_no").collect()]
    assert got == [(0, 0, 2), (1, 3, 3), (2, 4, 5)]


def test_heading_runs_break_at_stars(spark):
    got = sorted((r.label, r.start, r.end, r.n_lines) for r in L.heading_runs(docs(spark, "AAA BBB\nCCC\n*DDD*\nEee")).collect())
    assert got == [(O, 0, 11, 2), (O_, 12, 17, 1)]


def test_bold_blocks_merge_on_a_line(spark):
    got = [(r.start, r.end, r.content) for r in L.bold_blocks(docs(spark, "**a** **b**\n**c** **d")).orderBy("start").collect()]
    assert got == [(0, 11, "a** **b"), (12, 17, "c")]


def test_ordinal_bold_stays_a_heading(spark):
    assert labelled(spark, "**N.º**") == [(O_, 0, 7)]


def test_paragraph_goes_on_over_lower_case(spark):
    assert labelled(spark, "The first\nline ends.\ncontinues\nNext one.") == [(P, 0, 40)]
    assert labelled(spark, "Only one line.") == [(B, 0, 14)]
    assert labelled(spark, "small\nBig one.\nMore.") == [(B, 0, 5), (B, 6, 14), (B, 15, 20)]


def test_spans_never_overlap_and_cover_visible_lines(spark):
    text = "ORG ONE\n**Sumário**\n**Title one** **more**\n12 - 3\nBody text\ngoes on.\n*STAR*\n\nDireção Regional do Trabalho x"
    got = labelled(spark, text)
    assert all(a[2] <= b[1] for a, b in zip(got, got[1:], strict=False))
    assert {x[0] for x in got} == {O, O_, D, V.JUNK, P, V.SUMMARY, V.MARKER}


def test_longest_first(spark):
    rows = spark.createDataFrame([([(0, 5, "a"), (4, 20, "b"), (18, 22, "c")], [(20, 22, "d")])], f"x {L.SPANS}, y {L.SPANS}")
    assert [s.label for s in rows.select(L.resolved(F.col("x"), F.col("y")).alias("z")).first().z] == ["b", "d"]


def greedy(*rules):
    every = sorted((s - e, s, n, label, e) for n, rule in enumerate(rules) for s, e, label in rule)
    kept = []
    for less, s, _, label, e in every:
        if all(k[1] <= s or k[0] >= e for k in kept):
            kept.append((s, e, label))
    return sorted(kept)


def test_resolution_equals_greedy_over_all(spark):
    rng = random.Random(8)

    def drawn(n, wide):
        return sorted((s := rng.randint(0, 900), s + rng.randint(1, wide), rng.choice("abc")) for _ in range(rng.randint(0, n)))

    cases = [(drawn(9, 300), drawn(9, 60)) for _ in range(60)] + [(drawn(600, 4), drawn(40, 90)), ([], [])]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], f"i int, x {L.SPANS}, y {L.SPANS}")
    got = [[tuple(s) for s in r.z] for r in rows.select("i", L.resolved(F.col("x"), F.col("y")).alias("z")).orderBy("i").collect()]
    assert got == [greedy(a, b) for a, b in cases]


def test_lines_beside_spans(spark):
    rng = random.Random(9)
    text = "\n".join("w" * rng.randint(1, 9) for _ in range(700))
    ends = sorted(rng.sample(range(len(text)), 240))
    spans = [(a, b, "x") for a, b in zip(ends[::2], ends[1::2], strict=True)]
    rows = spark.createDataFrame([(text, spans), (text, spans[:1]), (text, [])], f"text string, x {L.SPANS}")
    got = rows.select(L.beside(L.visible_lines(F.col("text")), F.col("x")).alias("z"), "x").collect()
    lines_ = [(r.start, r.end) for r in lines(docs(spark, text)).orderBy("line_no").collect()]
    for r in got:
        assert [s.start for s in r.z] == [a for a, b in lines_ if not any(s.start < b and s.end > a for s in r.x)]


def test_rows_that_repeat_a_key_are_labelled_alone(spark):
    texts = ["AAA BBB\nCCC\n**a** **b**\nText one\ngoes on.", "*STAR*\nX.\n12 - 3", "AAA BBB\nCCC\n**a** **b**\nText one\ngoes on.", None, "lower\nUpper"]
    alone = [spans_ for t in texts for spans_ in labelled(spark, t)]
    for ids in ([1, 1, 1, 1, 1], [None, None, 7, 7, None]):
        rows = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
        assert sorted((r.label, r.start, r.end) for r in L.label(rows).collect()) == sorted(alone)


def test_single_scan_without_shuffle(spark):
    plan = L.label(docs(spark, "A\nb"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and plan.count("Scan") == 1


def test_long_text_is_labelled_in_order(spark):
    text = "\n".join(["AAA", "**t** one", "lower text", "Upper. ", "12 - 3", ""] * 900)
    got = labelled(spark, text)
    assert [x[0] for x in got] == [O, D, B, B, V.JUNK] * 900
    assert [x[1:] for x in got[-5:]] == [(n + len(text) - 40, m + len(text) - 40) for n, m in ((0, 3), (4, 9), (14, 24), (25, 31), (33, 39))]


def test_empty_and_null_documents(spark):
    assert L.label(docs(spark, None, "", "\n \n")).count() == 0


def test_merge_bold_runs(spark):
    rows = lines(docs(spark, "**A**\n**B**\n|x|\n**c**\nd"))
    assert M.rejoin(M.merge_bold_runs(rows)).first().text == "**A\nB**\n|x|\n**c**\nd"
    assert M.rejoin(M.merge_bold_runs(lines(docs(spark, "**AA**\n**BB**\n**cc**")), all_caps=True)).first().text == "**AA\nBB**\n**cc**"


def test_one_bold_block(spark):
    rows = spark.createDataFrame([("**SECRETARIA** DOS**Humanos**",), ("**a**",), ("|**a**|",), ("****",)], "s string")
    assert [r.x for r in rows.select(M.one_bold_block("s").alias("x")).collect()] == ["**SECRETARIA DOS Humanos**", "**a**", "|**a**|", "****"]


def split(spark, labels, texts):
    rows = spans(spark, labels, texts)
    return S.split_at_repeat(rows, rows.groupBy("doc_id").agg(F.max("end").alias("n_chars"))).first()


def test_split_at_last_marker_and_by_containment(spark):
    r = split(spark, [V.SUMMARY, O, V.SUMMARY, O, D, O], ["s", "X", "s", "AB", "t", "ab"])
    assert (r.reason, r.marker_end, r.first_org, r.boundary) == (None, 5, "AB", 11)
    assert split(spark, [V.SUMMARY, O, O], ["s", "A B C", "A B"]).boundary == 8
    assert split(spark, [O], ["A"]).reason == "no_sumario"
    assert split(spark, [V.SUMMARY, D], ["s", "A"]).reason == "no_org_after_sumario"
    assert split(spark, [V.SUMMARY, O, O], ["s", "A", "B"]).reason == "no_repeat_match"


def kinds(rows):
    return [(r.kind, r.head.seq, r.tail.seq) for r in rows.orderBy("ord").collect()]


def test_star_is_sticky(spark):
    got = [r.paragraph_id for r in R.paragraphs_by_star(spans(spark, [O, D, O_, O, D, O, D])).orderBy("seq").collect()]
    assert got == [0, 0, 1, 1, 1, 1, 1]


def test_star_without_plain_heading_gives_nothing(spark):
    assert R.relations_by_star(spans(spark, [O_, D, B])).count() == 0


def test_first_body_of_each_kind(spark):
    assert kinds(R.relations_by_star(spans(spark, [O, D, B, B, P]))) == [(V.ORG_TITLE, 1, 2), (V.TITLE_BODY, 2, 3), (V.TITLE_BODY, 2, 5)]


def test_modes(spark):
    assert kinds(R.relations_by_title(spans(spark, [O, M_, D, P, P]))) == [(V.ORG_TITLE, 1, 3), (V.TITLE_PARAGRAPH, 3, 4), (V.TITLE_PARAGRAPH, 3, 5)]
    assert kinds(R.relations_by_title(spans(spark, [O, D, P, P]))) == [(V.ORG_TITLE, 1, 2), (V.TITLE_PARAGRAPH, 2, 3)]
    assert kinds(R.relations_by_title(spans(spark, [O, B, P]))) == [(V.ORG_BODY, 1, 2), (V.ORG_PARAGRAPH, 1, 3)]
    assert (V.ORG_TITLE, 1, 4) in kinds(R.relations_by_title(spans(spark, [O, D, P, D, P])))
    assert (V.TITLE_PARAGRAPH, 2, 4) not in kinds(R.relations_by_title(spans(spark, [M_, D, P, P])))


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


def test_title_relations_copy_no_spans(spark):
    plan = plan_of(R.relations_by_title(spans(spark, [O, M_, D, P, P])))
    assert plan.count("Generate") == 0 and plan.count("Exchange hashpartitioning") == 1


def test_items_of_stars_read_relations_once(spark):
    plan = plan_of(Y.items_by_star(R.relations_by_star(spans(spark, [O_, O, D, B]))))
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_next_text_is_that_of_the_block(spark):
    got = kinds(R.relations_by_star(spans(spark, [D, P, O, D, O, B, O_, D, B, O, D, P, B])))
    assert got == [(V.TITLE_BODY, 1, 2), (V.ORG_TITLE, 3, 4), (V.STAR_ORG, 7, 10), (V.ORG_TITLE, 10, 11), (V.TITLE_BODY, 11, 12), (V.TITLE_BODY, 11, 13)]


def test_merges_keep_what_stands_between(spark):
    rows = spans(spark, [O, O, O, O], ["A-B ", "**C**", "D", "E"])
    text = spark.createDataFrame([(0, "A-B  **C**;D:E")], "doc_id long, text string")
    rows = rows.withColumn("start", F.expr("element_at(array(0L, 5L, 11L, 13L), seq)")).withColumn("end", F.expr("element_at(array(4L, 10L, 12L, 14L), seq)"))
    wanted = spark.createDataFrame([(0, "ABCD"), (0, "E")], "doc_id long, org_key string")
    got = [(r.start, r.end, r.width, r.org_key, r.text) for r in S.coalesced_anchors(rows, text, wanted).orderBy("start").collect()]
    assert got == [(0, 12, 3, "ABCD", "A-B  **C**;D"), (13, 14, 1, "E", "E")]


def test_nested_steps_are_written_once(spark):
    rows = spans(spark, [O_, O, B], ["TOPO", "SUB", "x"])
    items = spark.createDataFrame([(0, 0, "TOPO", 0, "SUB", ["a"])], "doc_id long, item int, top_text string, sub int, sub_text string, docs array<string>")
    assert plan_of(S.segment_nested(rows, text_of(rows), items)).count("Window [") <= 3


def test_sub_slices_label_texts_once(spark):
    segments = spark.createDataFrame([(0, "a", "x\n**Um titulo**\ny")], "doc_id long, segment string, text string")
    none = segments.select("doc_id", "segment", F.lit(0).alias("ord"), F.lit("").alias("title")).limit(0)
    out = S.sub_slices(segments, none)
    assert "Generate" not in plan_of(out)
    assert [(r.title, r.start, r.stop) for r in out.collect()] == [("Um titulo", 15, 17)]


def test_windows_of_a_name_are_compared_once(spark):
    orgs = spark.createDataFrame([(0, 1, "A B"), (0, 2, "none")], "doc_id long, id int, text string")
    windows = spark.createDataFrame([(0, i, "C" if i < 2 else "A B") for i in range(9)], "doc_id long, idx int, name string")
    first = S.first_of_names(windows)
    assert first.count() == 2
    assert {(r.id, r.idx, r.score) for r in S.best_windows(orgs, first).collect()} == {(1, 2, 1.0), (2, 0, 0.0)}


def test_items(spark):
    flat = Y.items_by_star(R.relations_by_star(spans(spark, [O, D, D], ["A", "x", "y"]))).first()
    assert (flat.org.text, [d.text for d in flat.docs], flat.top_org) == ("A", ["x", "y"], None)
    star = Y.items_by_star(R.relations_by_star(spans(spark, [O_, O, D, O, D], ["S", "A", "x", "A", "y"]))).first()
    assert [(s.org.text, [d.text for d in s.docs]) for s in star.sub_orgs] == [("A", ["x", "y"])]
    rows = R.relations_by_title(spans(spark, [O, D, P, O, D], ["A", "x", "p", "B", "y"]))
    got = [(r.org_ids, r.doc_name.text, [c.child for c in r.children]) for r in Y.items_by_title(rows).orderBy("paragraph_id").collect()]
    assert got == [([1], "x", ["p"]), ([2], "y", [])]


def test_unreachable_kinds(spark):
    got = {k for k, _, _ in kinds(R.relations_by_star(spans(spark, [O, O_, D, O, D, P, O_, O, D])))}
    assert not got & {V.ORG_TO_STAR, V.STAR_TITLE, V.TITLE_PARAGRAPH}


def test_coalesced_anchors(spark):
    rows = spans(spark, [O, O, O, D, O], ["A", "B", "C", "t", "A"])
    wanted = spark.createDataFrame([(0, "ABC"), (0, "A"), (0, "")], "doc_id long, org_key string")
    got = [(r.start, r.end, r.org_key) for r in S.coalesced_anchors(rows, text_of(rows), wanted).orderBy("start").collect()]
    assert got == [(0, 5, "ABC"), (8, 9, "A")]


def flat(spark, labels, texts, docs_):
    rows = spans(spark, labels, texts)
    items = spark.createDataFrame([(0, 0, texts[0], docs_)], "doc_id long, item int, org_text string, docs array<string>")
    r = S.segment_flat(rows, text_of(rows), items).first()
    return r.status, [s.doc_name for s in r.slices or []]


def test_flat_segments(spark):
    assert flat(spark, [O, D, D], ["A", "x", "y"], ["x", "y"]) == ("ok", ["x", "y"])
    assert flat(spark, [O, D, D], ["A", "X", "Y"], ["Z", "X", "Y"]) == ("partial", ["X", "Y"])
    assert flat(spark, [O, B], ["A", "text"], ["x"]) == ("ok", ["x"])
    assert flat(spark, [O, B], ["A", "text"], ["x", "y"]) == ("doc_missing", [])
    assert flat(spark, [O, D], ["A", "x"], []) == ("ok", ["x"])
    assert flat(spark, [D, D], ["A", "x"], ["x"]) == ("org_missing", [])


def test_title_cascade(spark):
    wanted = spark.createDataFrame([(0, 1, "Alpha beta"), (0, 2, "Gamma delta"), (0, 3, "Ação épsilon"), (0, 4, "Abcdefghij klm"), (0, 5, "None like it")], "doc_id long, item long, title string")
    titles = spark.createDataFrame([(0, 10, "**ALPHA  BETA:**"), (0, 20, "G a m m a delta"), (0, 30, "acao epsilon"), (0, 40, "Abcdefghij k")], "doc_id long, start long, title string")
    got = {r.item: (r.start, round(r.confidence, 4)) for r in S.title_matches(wanted, titles).collect()}
    assert got == {1: (10, 1.0), 2: (20, 0.95), 3: (30, 0.9), 4: (40, round(0.8 * 11 / 13, 4))}


def test_children_and_trigrams(spark):
    long_a, long_b = "abcdefghijklmnopqrstuvwxyzabcd", "abcdefghijklmnopqrstuvwxyzzzzz"
    headers = spark.createDataFrame([(0, 0, 0, "nothing"), (0, 0, 1, long_b), (0, 1, 0, "Tí tulo")], "doc_id long, block int, line_no int, header string")
    allowed = spark.createDataFrame([(0, 0, long_a), (0, 1, "titulo")], "doc_id long, ord int, title string")
    got = {r.block: (r.title, r["rank"]) for r in S.likely_children(headers, allowed).collect()}
    assert got == {0: (long_a, 4), 1: ("titulo", 2)}


def test_windows_fall_back(spark):
    rows = spans(spark, [O, D, O, D], ["CAMARA UM", "x", "OUTRA COISA", "y"])
    ends = rows.groupBy("doc_id").agg(F.max("end").alias("n_chars"))
    orgs = spark.createDataFrame([(0, 1, "camara um")], "doc_id long, id int, text string")
    assert [(r.idx, r.start, r.stop) for r in S.kept_windows(rows, orgs, ends).collect()] == [(0, 0, 25)]
    none = spark.createDataFrame([(0, 1, "zzz")], "doc_id long, id int, text string")
    windows = S.kept_windows(rows, none, ends)
    assert windows.first().name == "(global)"
    assert S.best_windows(none, windows).first().status == "org_unanchored"


def test_untitled_item_takes_the_window(spark):
    rows = spans(spark, [O, D, P], ["CAMARA UM", "x", "p"])
    orgs = spark.createDataFrame([(0, 1, "CAMARA UM")], "doc_id long, id int, text string")
    items = spark.createDataFrame([(0, 0, [1], None), (0, 1, [1], "x"), (0, 2, [1], "absent"), (0, 3, [], "x")], "doc_id long, item int, org_ids array<int>, title string")
    got = {r.item: (r.status, r.confidence, r.start, r.stop) for r in S.segment_titles(rows, text_of(rows), orgs, items).collect()}
    assert got == {0: ("doc_children_segment", 0.5, 0, 13), 1: ("doc_type_segment", 1.0, 11, 13), 2: ("doc_type_unanchored", 0.0, None, None)}


def test_lines_after_the_first_are_matched(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(8)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 9))) for _ in range(80)]
    left = [(i % 7, i // 7, t) for i, t in enumerate(lines[:30])]
    right = [(i % 9, i // 9, t) for i, t in enumerate([*lines[20:], *(t[:-4] for t in lines[:30])])] + [(99, 4, None), (99, 5, ""), (99, 6, "É" * 30)]

    def grams(t):
        s = "".join(c for c in (t or "").replace("É", "e").lower() if c.isalnum())
        return {s[i : i + 3] for i in range(len(s) - 2)} if len(s) >= 20 else set()

    want = sorted((a, i, b, j, round(len(grams(s) & grams(t)) / len(grams(s) | grams(t)), 6)) for a, i, s in left for b, j, t in right if grams(s) and grams(t) and len(grams(s) & grams(t)) / len(grams(s) | grams(t)) >= 0.6)
    got = S.similar_lines(spark.createDataFrame(left, "a long, a_line int, text string"), spark.createDataFrame(right, "b long, b_line int, text string"))
    assert sorted((r.a, r.a_line, r.b, r.b_line, round(r.jaccard, 6)) for r in got.collect()) == want
    assert len(want) > 20


def test_title_outside_every_window_runs_to_the_end(spark):
    rows = spans(spark, [D, P, O, D], ["antes", "corpo um", "CAMARA UM", "depois"])
    orgs = spark.createDataFrame([(0, 1, "CAMARA UM")], "doc_id long, id int, text string")
    items = spark.createDataFrame([(0, 0, [1], "antes"), (0, 1, [1], "**:**"), (0, 2, [1], "Depois:")], "doc_id long, item int, org_ids array<int>, title string")
    got = {r.item: (r.title, r.status, r.confidence, r.start, r.stop) for r in S.segment_titles(rows, text_of(rows), orgs, items).collect()}
    assert got == {0: ("antes", "doc_type_segment", 1.0, 5, 31), 1: ("(Preambulo)", "doc_children_segment", 0.5, 15, 31), 2: ("Depois", "doc_type_segment", 1.0, 31, 31)}


def test_windows_unwrap_bold_organisations(spark):
    rows = spans(spark, [O, D], ["CAMARA DO PORTO NOVO", "x"])
    ends = rows.groupBy("doc_id").agg(F.max("end").alias("n_chars"))
    for name in ("CAMARA PORTO", "**CAMARA PORTO**"):
        orgs = spark.createDataFrame([(0, 1, name)], "doc_id long, id int, text string")
        assert S.kept_windows(rows, orgs, ends).first().name == "CAMARA DO PORTO NOVO"


def nested(spark, labels, names, subs):
    rows = spans(spark, labels, names)
    items = spark.createDataFrame([(0, 7, names[0], i, name, docs_) for i, (name, docs_) in enumerate(subs)], "doc_id long, item int, top_text string, sub int, sub_text string, docs array<string>")
    text = text_of(rows).first().text
    out = S.segment_nested(rows, text_of(rows), items)
    return [(r.sub, r.status, [(s.doc_name, text[s.start : s.stop].strip()) for s in r.slices]) for r in out.orderBy("sub").collect()], S.summary(out).first()


def test_nested_places_are_coalesced_and_named_in_order(spark):
    got, total = nested(spark, [O_, O, O, B, O, B, O, B], ["TOPO", "SUB UM", "DOIS", "um", "OUTRA", "dois", "SUB UM DOIS", "tres"], [("SUB UM DOIS", ["**a**"]), ("OUTRA", ["x"]), ("AUSENTE", ["y"])])
    assert got == [
        (0, "partial", [("a", "SUB UM DOIS um"), ("SUB UM DOIS", "SUB UM DOIS tres")]),
        (1, "ok", [("x", "OUTRA dois")]),
        (2, "org_missing", []),
    ]
    assert (total.orgs_total, total.org_ok, total.org_partial, total.org_missing, total.docs_expected, total.docs_matched, total.docs_matched_ref) == (3, 1, 1, 1, 3, 2, 3)


def test_nested_without_its_top(spark):
    rows = spans(spark, [O, B], ["SUB", "x"])
    items = spark.createDataFrame([(0, 0, "TOPO", 0, "SUB", ["a", "b"])], "doc_id long, item int, top_text string, sub int, sub_text string, docs array<string>")
    out = S.segment_nested(rows, text_of(rows), items)
    assert [(r.status, r.n_slices, r.top_found) for r in out.collect()] == [("org_missing", 0, False)]
    assert (S.summary(out).first().docs_expected, S.summary(out).first().docs_expected_ref) == (2, 0)


def test_allowed_children_of_all_fields(spark):
    items = spark.createDataFrame(
        [(0, 1, ["Titulo A:", "t i t u l o a"], [(None, "Titulo B", None), (("Titulo C",), "ignored", "x"), (None, None, "um paragrafo\nlongo")], [(("**Titulo D**",),), ((None,),)]), (0, 2, None, None, None)],
        "doc_id long, item int, allowed_children array<string>, children array<struct<doc_name: struct<text: string>, text: string, child: string>>, bodies array<struct<doc_name: struct<text: string>>>",
    )
    got = [r.title for r in Y.allowed_children(items).orderBy("item", "ord").collect()]
    assert got == ["Titulo A", "Titulo B", "Titulo C", "um paragrafo longo", "Titulo D"]
    assert Y.allowed_children(items.select("doc_id", "item")).count() == 0
