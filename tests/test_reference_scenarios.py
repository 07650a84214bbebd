"""The original tools' own test scenarios, restated on our operators with our
own inputs: abstract-page extraction, tolerant JSON parsing, the safety
check, retries, and the topic verdict rules."""
import json

from pyspark.sql import functions as F

from quire.functions import fixed
from quire.functions import jsonrepair as jr
from quire.operators import infer, topic
from quire.sources import pages

ABSTRACT_PAGE = """
<html><body>
  <h1 class="title mathjax"><span class="descriptor">Title:</span>Grasping Soft Objects With Tactile Skins</h1>
  <div class="authors"><span class="descriptor">Authors:</span>
    <a href="/a/1">Mira Okafor</a>, <a href="/a/2">Tomas Lindqvist</a>, <a href="/a/3"> Ren Sato </a>
  </div>
  <blockquote class="abstract mathjax">
    <span class="descriptor">Abstract:</span>
    We study   grasping with tactile sensing.
  </blockquote>
  <table>
    <tr><td class="tablecell label">Comments:</td><td class="tablecell comments mathjax">12 pages, 5 figures</td></tr>
    <tr><td class="tablecell label">Subjects:</td>
        <td class="tablecell subjects"><span class="primary-subject">Robotics (cs.RO)</span>;
        Computer Vision (cs.CV)</td></tr>
  </table>
</body></html>
"""


def test_abstract_page_full_record(spark):
    df = spark.createDataFrame([("https://example.org/abs/2601.00042", ABSTRACT_PAGE)], "url string, html string")
    r = pages.abstract_record(df).collect()[0]
    assert r["id"] == "2601.00042"
    assert r["title"] == "Grasping Soft Objects With Tactile Skins"
    assert r["authors"] == ["Mira Okafor", "Tomas Lindqvist", "Ren Sato"]
    # text nodes are stripped, blank ones dropped; inner spacing is kept
    assert r["summary"] == "We study   grasping with tactile sensing."
    assert r["comment"] == "12 pages, 5 figures"
    assert r["categories"] == ["cs.RO", "cs.CV"]


def _ai(spark, responses):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(responses)], "i int, response string")
    return [r.AI for r in jr.with_ai(df, "response").orderBy("i").collect()]


def test_summary_json_plain_fenced_garbage(spark):
    plain = json.dumps({"tldr": "short", "motivation": "why", "method": "how", "result": "what",
                        "conclusion": "so"}, indent=2)
    fenced = "```json\n" + json.dumps({"tldr": "fenced one", "method": "m"}) + "\n```\nSome closing words."
    out = _ai(spark, [plain, fenced, "not json at all"])
    assert out[0]["tldr"] == "short" and out[0]["method"] == "how" and out[0]["parse_status"] == "ok"
    assert out[1]["tldr"] == "fenced one" and out[1]["method"] == "m"
    assert out[1]["result"] == fixed.AI_DEFAULTS["result"]          # missing field -> default
    assert out[2]["tldr"] == fixed.AI_DEFAULTS["tldr"] and out[2]["parse_status"] == "bad_json"


def test_summary_json_edge_shapes(spark):
    rs = ['{"tldr": "a"} and then more text',           # object + trailing text
          'Here you go: {"tldr": "b"} -- end',           # text around braces
          '[{"tldr": "c"}]',                              # array: braces span wins
          '',                                             # empty
          '{"tldr": null, "method": {"x": 1}}',           # null field, nested field
          '{"tldr": "first", "tldr": "second"}',          # duplicate key: last wins
          "{'tldr': 'single'}",                           # single quotes: rejected
          '{"tldr": "cut off']                            # cut off
    out = _ai(spark, rs)
    assert out[0]["tldr"] == "a"
    assert out[1]["tldr"] == "b"
    assert out[2]["tldr"] == "c"
    assert out[3]["parse_status"] == "bad_json"
    assert out[4]["tldr"] == fixed.AI_DEFAULTS["tldr"] and out[4]["method"] == '{"x":1}'
    assert out[5]["tldr"] == "second"
    assert out[6]["parse_status"] == "bad_json"
    assert out[7]["parse_status"] == "bad_json"


class Outcome:
    """A scripted service: each call pops the next outcome (exception or value)."""

    def __init__(self, *outcomes):
        self.outcomes = list(outcomes)
        self.calls = 0

    def __call__(self, prompt):
        self.calls += 1
        o = self.outcomes.pop(0) if len(self.outcomes) > 1 else self.outcomes[0]
        if isinstance(o, Exception):
            raise o
        return o


def test_retry_then_success():
    svc = Outcome(RuntimeError("transient"), "fine")
    res, attempts = infer.call_with_retries(svc, "p", retries=1, sleep=lambda s: None)
    assert res == "fine" and attempts == 2 and svc.calls == 2


def test_backoff_delays_are_bounded():
    delays = []
    svc = Outcome(RuntimeError("down"))
    try:
        infer.call_with_retries(svc, "p", retries=3, base=2.0, cap=5.0, sleep=delays.append)
    except RuntimeError:
        pass
    assert svc.calls == 4 and len(delays) == 3
    for k, d in enumerate(delays):
        lo = min(5.0, 2.0 * 2 ** k)
        assert lo <= d <= lo + min(2.0, lo)


def _safety(spark, fn):
    df = spark.createDataFrame([("some abstract",)], "text string")
    return infer.safety_verdicts(df, fn, sleep=lambda s: None, retries=0).collect()[0]["flagged"]


def test_safety_check_fails_open(spark):
    def error(_):
        raise ConnectionError("no route")

    def unavailable(_):
        raise RuntimeError("status 503")
    assert _safety(spark, error) is False
    assert _safety(spark, unavailable) is False
    assert _safety(spark, lambda _: {}) is False
    assert _safety(spark, lambda _: {"sensitive": True}) is True


def _verdicts(spark, rows, keep=False):
    df = spark.createDataFrame(rows, "i int, response string, status string")
    c = topic.classify(df, "response", "status", keep_uncertain_enabled=keep)
    return [r.topic_filter for r in c.orderBy("i").collect()]


def test_topic_verdict_plain_fenced_garbage(spark):
    plain = json.dumps({"relevant": True, "confidence": 0.9, "reason": "robots", "topics": ["manipulation"]})
    fenced = "```\n" + json.dumps({"relevant": False, "confidence": 0.8, "reason": "vision only"}) + "\n```"
    v = _verdicts(spark, [(0, plain, "ok"), (1, fenced, "ok"), (2, "I think yes", "ok")])
    assert v[0]["relevant"] is True and v[0]["confidence"] == 0.9 and v[0]["topics"] == ["manipulation"]
    assert v[1]["relevant"] is False and v[1]["reason"] == "vision only"
    assert v[2]["relevant"] is False and v[2]["reason"] == fixed.TOPIC_DEFAULT_REASON   # fails closed


def test_topic_classifier_error_fails_closed(spark):
    v = _verdicts(spark, [(0, None, "error")], keep=True)
    assert v[0]["relevant"] is False and v[0]["parse_status"] == "error"   # not rescued (Q8)


def test_uncertain_rejection_kept(spark):
    low = json.dumps({"relevant": False, "confidence": 0.4, "reason": "unsure"})
    high = json.dumps({"relevant": False, "confidence": 0.95, "reason": "clearly off"})
    v = _verdicts(spark, [(0, low, "ok"), (1, high, "ok")], keep=True)
    assert v[0]["relevant"] is True and v[0]["reason"] == "uncertain_keep: unsure"
    assert v[1]["relevant"] is False


def test_verdict_validation_rules(spark):
    rows = [(0, json.dumps({"relevant": "false", "confidence": "high", "topics": "one"}), "ok"),
            (1, json.dumps({"relevant": True, "topics": [f"t{i}" for i in range(12)], "reason": "r" * 900}), "ok"),
            (2, json.dumps({"confidence": 0.99}), "ok")]
    v = _verdicts(spark, rows)
    assert v[0]["relevant"] is False and v[0]["confidence"] == 0.0 and v[0]["topics"] == []   # Q7
    assert len(v[1]["topics"]) == 8 and len(v[1]["reason"]) == 500
    assert v[2]["parse_status"] == "bad_json"          # needs the key "relevant"


def test_message_parts_are_flattened(spark):
    df = spark.createDataFrame([('[{"type": "text", "text": "ab"}, "cd", {"type": "image"}]',), ("plain",)], "c string")
    got = [r[0] for r in df.select(jr.flatten_parts("c")).collect()]
    assert got == ["abcd", "plain"]


def test_batch_enrich_keeps_failed_rows(spark):
    df = spark.createDataFrame([("1", "fine text", 1), ("2", "zz fails", 2), ("1", "dup", 3)],
                               "id string, summary string, seq long")

    def fn(prompt):
        if "zz" in prompt:
            raise RuntimeError("boom")
        return json.dumps({"tldr": "ok"})
    out = {r.id: r for r in infer.enrich(df, fn, retries=1, sleep=lambda s: None).collect()}
    assert set(out) == {"1", "2"}                                   # first-seen distinct by id
    assert out["1"].AI["tldr"] == "ok"
    # A failed call gets the generation defaults; only a died row the processing set.
    assert out["2"].AI["tldr"] == fixed.AI_DEFAULTS["tldr"] and out["2"].attempts == 2
    died = jr.with_ai(spark.createDataFrame([(None, "failed")], "response string, status string"), "response", "status")
    assert died.collect()[0].AI["tldr"] == fixed.AI_PROCESSING_FAILED


def test_repeated_and_null_ids_neither_multiply_nor_pay_twice(spark):
    calls = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("1", "a", "T", ["x"], ["c"])] * 3 + [(None, "b", "T", ["x"], ["c"])] * 2,
                               "id string, summary string, title string, authors array<string>, categories array<string>")

    def fn(prompt):
        calls.add(1)
        return json.dumps({"relevant": True, "confidence": 1})
    got = infer.classify(df, fn, sleep=lambda s: None, scope="robots").collect()
    assert len(got) == 5 and all(r.topic_filter["relevant"] for r in got) and calls.value == 2
    assert len(infer.enrich(df, fn, sleep=lambda s: None).collect()) == 3        # one of id 1, both without id
