"""Search, matching, ranking and display scalars on small in-code fixtures."""
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import papers as pf
from quire.functions import text as tf
from quire.operators import match, seeds
from quire.plans import search


def papers(spark, rows):
    return spark.createDataFrame(
        rows, "id string, seq long, date date, title string, summary string, authors array<string>, "
              "categories array<string>")


def base(spark):
    import datetime as dt
    d = dt.date(2026, 1, 5)
    return papers(spark, [
        ("1", 1, d, "Learning in C++ Robots", "We use a.b notation", ["Ann Lee", "Bo Chen"], ["cs.RO", "cs.LG"]),
        ("2", 2, d, "Vision Transformers", "Nothing here", ["Cy Dale"], ["cs.CV"]),
        ("3", 3, d, "Robotics at scale", "robot fleets", ["Ann Leeds"], ["cs.RO"]),
        ("4", 4, d, "Axb is not a.b", "", [], ["cs.CV"]),
    ])


def test_terms_case_regex_chars_and_nesting(spark):
    v = match.search_view(base(spark))
    out = {r.id: (r.is_matched, r.match_reason) for r in
           match.match_terms(v, keywords=["ROBOT", "c++", "a.b", "zzz"]).collect()}
    assert out["1"] == (True, "关键词: ROBOT, c++, a.b")       # case-insensitive, literal regex chars
    assert out["2"] == (False, None)
    assert out["3"] == (True, "关键词: ROBOT")                  # 'robot' inside 'Robotics'
    assert out["4"] == (True, "关键词: a.b")                    # '.' is literal: 'Axb' does not match


def test_keyword_or_author_and_no_terms(spark):
    v = match.search_view(base(spark))
    out = {r.id: r.match_reason for r in match.match_terms(v, ["vision"], ["ann lee"]).collect()}
    assert out["1"] == "作者: ann lee"
    assert out["2"] == "关键词: vision"
    assert out["3"] == "作者: ann lee"                            # substring of 'Ann Leeds'
    everything = match.match_terms(v, None, []).where("is_matched").count()
    assert everything == 4                                        # Q1: no terms = no condition


def test_search_request_category_and_matched_only(spark):
    r = search.search_request(base(spark), "cs.RO", ["robot"], None)
    assert sorted(x.id for x in r.collect()) == ["1", "3"]
    r = search.search_request(base(spark), "all", ["transformers"], None)
    assert [x.id for x in r.collect()] == ["2"]


def test_reading_list_match_first_stable(spark):
    ranked = search.reading_list(base(spark), "all", ["robot"], None)
    order = [r.id for r in ranked.orderBy("rank").collect()]
    # matched first (category order, then listing order), then the rest
    assert order == ["1", "3", "2", "4"]
    nb = {r.id: (r.prev_id, r.next_id) for r in match.circular_neighbours(ranked).collect()}
    assert nb["1"] == ("4", "3") and nb["4"] == ("2", "1")     # wraps at both ends


def test_text_search_over_nine_fields(spark):
    v = match.search_view(base(spark))
    hits = {r.id for r in match.match_text(v, "lee, bo").where("is_matched").collect()}
    assert hits == {"1"}


def test_term_tables_of_any_size(spark):
    v = match.search_view(base(spark))
    few = spark.createDataFrame([("robot",), ("A.B",), ("c++",), ("",), (None,), ("robot",)], "term string")
    many = spark.createDataFrame([(t,) for t in ["robot", "A.B", "c++"] + [f"nohit{i}" for i in range(60)]],
                                 "term string")
    a = sorted(map(tuple, match.term_hits(v, few, match.keyword_haystack()).collect()))
    b = sorted(map(tuple, match.term_hits(v, many, match.keyword_haystack()).collect()))
    assert a == b == [("1", "A.B"), ("1", "c++"), ("1", "robot"), ("3", "robot"), ("4", "A.B")]
    assert match.term_hits(v, few.where("false"), match.keyword_haystack()).count() == 0
    one = spark.createDataFrame([("x",), ("zz",), ("Robots We use a.b",)], "term string")
    got = sorted(map(tuple, match.term_hits(v, one, match.keyword_haystack()).collect()))
    assert got == [("1", "Robots We use a.b"), ("4", "x")]


def test_preferences_per_user(spark):
    v = match.search_view(base(spark))
    prefs = spark.createDataFrame([(1, "keyword", "vision"), (1, "author", "Cy"), (2, "keyword", "fleet"), (3, "keyword", "absent"),
                                   (3, "author", "ann")], "user_id long, kind string, term string")
    got = sorted(map(tuple, match.preference_hits(v, prefs, 1).collect()))
    assert got == [(1, "2", "author", "Cy"), (1, "2", "keyword", "vision")]
    counts = sorted(map(tuple, match.preference_counts(v, prefs).collect()))
    assert counts == [(1, "author", "Cy", 1), (1, "keyword", "vision", 1), (2, "keyword", "fleet", 1),
                      (3, "author", "ann", 2), (3, "keyword", "absent", 0)]


def test_author_abbreviation(spark):
    names = ["", "A", "A, B, C, D", "A, B, C, D, E", "A, B, C, D, E, F, G, H, I"]
    df = spark.createDataFrame([(n,) for n in names], "a string")
    got = [r[0] for r in df.select(tf.abbreviate_authors("a")).collect()]
    assert got == ["", "A", "A, B, C, D", "A, B, ..., D, E", "A, B, ..., H, I"]


def test_highlight_longest_first(spark):
    df = spark.createDataFrame([("Deep robot learning",)], "t string")
    got = df.select(tf.highlight("t", ["robot", "robot learning"])).collect()[0][0]
    assert got == 'Deep <span class="highlight-match">robot learning</span>'


def test_code_links(spark):
    texts = ["see https://github.com/org/repo.git).", "code: https://github.com/me/toolkit",
             "https://github.com/me/proj, and more", "page https://team.github.io/site/v1.",
             "both https://x.github.io/p and https://github.com/a/b", "none here"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(pf.code_url("t")).collect()]
    assert got == ["https://github.com/org/repo", "https://github.com/me/toolkit", "https://github.com/me/proj",
                   "https://team.github.io/site/v1", "https://github.com/a/b", None]


def test_categories_coercion(spark):
    df = spark.createDataFrame([('["cs.CV", "cs.AI"]',), ("cs.RO",), ("[]",), (None,)], "c string")
    got = [r[0] for r in df.select(pf.coerce_categories("c")).collect()]
    assert got == [["cs.CV", "cs.AI"], ["cs.RO"], [], None]
    prim = [r[0] for r in df.select(pf.primary_category(pf.coerce_categories("c"))).collect()]
    assert prim == ["cs.CV", "cs.RO", None, None]


def test_summary_choice_and_defaults(spark):
    df = spark.createDataFrame([("t", "abs"), ("", "abs"), (None, "abs")], "tldr string, summary string")
    got = [r[0] for r in df.select(pf.display_summary("tldr", "summary")).collect()]
    assert got == ["t", "abs", "abs"]
    assert fixed.KEYWORD_REASON_PREFIX.endswith(": ")


def test_response_document(spark):
    import json as _json
    r = search.search_request(base(spark), "all", ["robot"], ["cy"])
    doc = _json.loads(match.response_document(match.response_parts(r, "all", ["robot"], ["cy"])))
    assert doc["count"] == 3 and doc["keywords"] == ["robot"] and doc["author"] == ["cy"]
    assert [p["id"] for p in doc["papers"]] == ["2", "1", "3"]          # by category, then listing order
    assert doc["papers"][0]["reason"] == "作者: cy"


def test_search_without_listing_sequence(spark):
    import datetime as dt
    df = spark.createDataFrame([("b", dt.date(2026, 1, 5), "Robot arms", "x", ["A"], ["cs.RO"]),
                                ("a", dt.date(2026, 1, 5), "Robot legs", "y", ["B"], ["cs.RO"])],
                               "id string, date date, title string, summary string, authors array<string>, "
                               "categories array<string>")
    ranked = search.reading_list(df, "all", ["robot"], None)
    assert [r.id for r in ranked.orderBy("rank").collect()] == ["a", "b"]     # ordered by id


def test_neighbours_with_repeated_and_null_ids(spark):
    ranked = spark.createDataFrame([("a", 1, 3), ("a", 2, 3), (None, 3, 3)], "id string, rank long, n long").selectExpr("*", "date'2026-01-05' as date")
    got = [(r["rank"], r.prev_id, r.next_id) for r in match.circular_neighbours(ranked).orderBy("rank").collect()]
    assert got == [(1, None, "a"), (2, "a", None), (3, "a", "a")]


def test_one_language_variant_per_date(spark):
    import datetime as dt
    d1, d2 = dt.date(2026, 1, 5), dt.date(2026, 1, 6)
    ai = lambda t: {"tldr": t, "motivation": None, "method": "", "result": None, "conclusion": None}
    rows = [("1", d1, "Robot", "abs", ["A"], ["cs.RO"], "English", ai("short robot")), ("1", d1, "Robot", "abs", ["A"], ["cs.RO"], "Chinese", ai("")),
            ("2", d2, "Robot", "abs", ["A"], ["cs.RO"], "English", ai(None))]
    df = spark.createDataFrame(rows, "id string, date date, title string, summary string, authors array<string>, categories array<string>, "
                                     "language string, AI struct<tldr:string,motivation:string,method:string,result:string,conclusion:string>")
    both = search.search_request(df, "all", "robot, zz").collect()
    assert len(both) == 3
    one = {(r.id, r.language): (r.summary, r.code_url, r.code_stars) for r in search.search_request(df, "all", ["robot"], preferred="Chinese").collect()}
    assert one == {("1", "Chinese"): ("abs", "", 0), ("2", "English"): ("abs", "", 0)}
    assert {r.summary for r in search.search_request(df, "all", ["robot"], preferred="English").collect()} == {"short robot", "abs"}


def test_seed_codes_of_texts_are_found_over_bytes(spark, monkeypatch):
    """every run is found, across stretches too and in no two texts at
    once; no text is taken apart by a regular expression."""
    monkeypatch.setattr(seeds, "STRETCH", 5)
    texts = ["", None, "abcabcabc", "ü", "a", "bc", "über abcdefgh\0 日本", ""]
    known = np.ones(seeds.BITS, bool)
    lengths = [1, 2, 3, 7]
    for whole in (pa.array(texts), pa.array(["x", *texts])[1:]):
        got = seeds.found_codes(whole, lengths, known).to_pylist()
        for text, codes in zip(texts, got, strict=True):
            b = (text or "").encode()
            assert codes == sorted({n << 56 | int.from_bytes(b[i:i + n]) for n in lengths for i in range(len(b) - n + 1)})
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "a")], "id string, t string")
    terms = spark.createDataFrame([("A",), ("",), (None,)], "term string")
    hits = match.term_hits(df, terms, F.col("t"))
    assert [tuple(r) for r in hits.collect()] == [("1", "A")]
    assert "regexp" not in hits._jdf.queryExecution().toString()


def test_large_term_tables_verify_each_row(spark, monkeypatch):
    """Beyond the bounds of a small table a repeated key stands for its own texts only."""
    df = spark.createDataFrame([("1", "one überall"), ("1", "two"), ("2", "überallem"), ("3", None)], "id string, t string")
    terms = spark.createDataFrame([("ÜBERALL",), ("two",), ("o",), ("zz",), ("überall",)], "term string")
    want = sorted((r["id"], w) for r in df.collect() for w in ("ÜBERALL", "two", "o", "zz", "überall") if w.lower() in (r["t"] or ""))
    small = sorted(tuple(r) for r in match.term_hits(df, terms, F.col("t")).collect())
    monkeypatch.setattr(seeds, "SMALL_TERMS", 0)
    assert small == sorted(tuple(r) for r in match.term_hits(df, terms, F.col("t")).collect()) == want
