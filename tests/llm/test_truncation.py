"""Hidden limits are found, endings judged, and what only looks cut is left alone."""

import json
import random

import pytest
from pyspark.sql import functions as F

from phasemill.llm.truncation import inspect_ending, length_encodings, truncated_texts

SCHEMA = "doc_id long, text string, source string, page_id long, line string, form string, grp int"

WHOLE = [
    "It stands here.", "Who built it?", "It was so! \n\n", "彼は来た。", 'He called it "the least".', "One.<ref>A, ''B'', p. 3.</ref>", "One.{{citation needed|date=May 1}}", "One. {{lang|xx|{{{1}}}}}",
    "One.\n* Alpha\n* [[Beta]] (1801)", "#REDIRECT [[Alpha]]", "#REDIRECT [[Alpha]", "One.\n[[Category:Hill]]", "One.\n[[Category:Hill]", "One.\n{{stub}}", "One.\n{stub}}", "{| class=x\n| a\n|}", "{{Infobox\n| a = 3\n}}",
    "== See also ==", "One.\n<nowiki>{{unfinished</nowiki>", "[[Category:Hill]] It stands here.", "One.​﻿", "hahaha!!!", "haha!...", "\ufeff#REDIRECT [[Alpha]]", "One.\n* [[Beta]] \x07\x1b[0m.", "{{#if:{{{pop|}}}|{{{pop}}}.",
]
CUT = [
    "It stands he", "It was rebuilt in 1", "One. It has 3 islands, of whic…", "One. It has 3 isl...", "One. It has 3 islands ...", "One.\n* [", "彼は来", "One.<ref>A, ''B", "One.<ref>A, ''B'', p. 3.", "One.\n* [[Be", "One.\n* [[Beta]] (18", "#REDIRECT [[Alp", "One.\n[[Cat", "One.\n{{stu",
    "{| class=x\n| a || 3", "{{Infobox\n| na", "== See al", "It stands her�", "One. He said,", "One.\n{{#if:{{{",
]


def judge(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, s, p, "x", "y", 1) for i, (t, s, p) in enumerate(rows)], SCHEMA)
    judged, limits, _ = truncated_texts(df, "doc_id", "text", "source", "page_id", **kw)
    return {r["doc_id"]: r for r in judged.collect()}, {(r["source"], r["encoding"], r["limit"]) for r in limits.collect()}


def test_endings(spark):
    rows = [(t, "s", i) for i, t in enumerate(WHOLE + CUT)] + [(None, "s", 1), ("", "s", 1), (" \n﻿", "s", 1), ("Left op", None, 900)]
    got, limits = judge(spark, rows)
    assert limits == set()
    wrong = [rows[i][0] for i in range(len(WHOLE)) if got[i]["truncated"]] + [rows[i][0] for i in range(len(WHOLE), len(WHOLE + CUT)) if not got[i]["truncated"]]
    assert wrong == []
    n = len(WHOLE + CUT)
    assert set(got) == {*range(n), n + 3} and got[n + 3]["truncated"]


def test_lengths(spark):
    texts = ["a&b<c>", 'say "hi"\n', "é漢🙂", "it's\\n\r\t"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", *[v.alias(k) for k, v in length_encodings(F.col("t")).items()]).collect()
    import html

    for r in got:
        t = r["t"]
        want = {"chars": len(t), "utf8": len(t.encode()), "utf16": len(t.encode("utf-16-le")) // 2, "xml": len(html.escape(t, quote=False)), "html": len(html.escape(t).replace("&#x27;", "&#39;")), "json": len(json.dumps(t, ensure_ascii=False)) - 2, "json_ascii": len(json.dumps(t)) - 2, "crlf": len(t) + t.count("\n"), "crlf_utf8": len(t.encode()) + t.count("\n")}
        assert {k: r[k] for k in want} == want, t


@pytest.fixture(scope="module")
def limited():
    """Texts of three sources: one cuts at 100 characters, one at 120 bytes, one at 150 once escaped; some are just that long."""
    import html

    rng, rows = random.Random(4), []
    word = lambda: "".join(rng.choice("abcdefgé&\"") for _ in range(rng.randint(2, 9)))
    for page in range(900):
        text = " ".join(word() for _ in range(rng.randint(3, 40))) + "end."
        source = ("chars", "bytes", "escaped")[page % 3]
        if source == "chars":
            text = text[:100]
        elif source == "bytes":
            text = text.encode()[:120].decode(errors="ignore")
        else:
            while len(html.escape(text).replace("&#x27;", "&#39;")) > 150:
                text = text[:-1]
        rows.append((text, source, page))
    whole = [("w" * 95 + " end.", "chars", 5_000 + i) for i in range(10)]
    return rows + whole


def test_limits(spark, limited):
    got, limits = judge(spark, limited)
    assert ("chars", "chars", 100) in limits and ("bytes", "utf8", 120) in limits
    assert any(s == "escaped" and e.startswith("html") and n in (149, 150) for s, e, n in limits)
    for i, (t, s, _) in enumerate(limited):
        assert got[i]["truncated"] == (not t.endswith("end.")), (t, s)
        if s == "chars" and len(t) == 100:
            assert got[i]["at_limit"]


def test_fixed_lines_and_lists_at_a_limit(spark):
    rows = [(f"It is a stub {'x' * i}.\nReview state: none", "bot", i) for i in range(40)]
    rows += [("y" * 60 + "." + "\n* " + "n" * (36 - len(str(i))) + str(i), "list", 1000 + i) for i in range(30)]
    rows += [("z.\n* nameended", "list", 2000), ("y" * 87 + ".\n* nameended", "list", 2001)]
    got, limits = judge(spark, rows)
    assert not any(got[i]["truncated"] for i in range(40))
    assert ("list", "chars", 100) in limits
    # item names at the limit differ in digits only, and no text away from the limit ends with them
    assert all(got[i]["truncated"] == got[i]["at_limit"] for i in range(40, 70)) and any(got[i]["at_limit"] for i in range(40, 70))
    assert not got[70]["truncated"] and not got[71]["truncated"]


def test_no_texts(spark):
    assert judge(spark, []) == ({}, set())
    assert judge(spark, [("x" * 200_000 + ".", "s", 1)])[0][0]["truncated"] is False


def test_inspection_needs_no_other_text(spark):
    df = spark.createDataFrame([("One.\n* Alpha",), ("One.\nReview state: none",)], "t string")
    assert [r["ending"] for r in df.select(*[v.alias(k) for k, v in inspect_ending(F.col("t")).items()]).collect()] == ["unsure", "unsure"]


def test_fixed_lines_do_not_depend_on_the_number_of_texts(spark):
    """Last lines of a script, and one sentence cut anywhere, some places twice: judged alike among few and many texts, also if all are repeated under other ids."""
    sentence = "Its population fell from 900 to 700 between 1900 and 1950 mostly by"
    rows = [(f"Page {i} is a stub{'x' * (i % 23)}.\nReview state: none", "bot", i) for i in range(4)]
    rows += [(f"Page {i} has more{'y' * (i % 31)}. \n{sentence[: 9 + (i * 7) % 50]}", "people", 100 + i) for i in range(60)]
    rows += [(f"Page {i} has much more{'y' * (i % 31)}.\n{sentence[:40]}", "people", 300 + i) for i in range(3)]
    many = [(f"Filler {i}{'z' * (i % 40)} ends here.", "people", 10_000 + i) for i in range(3000)]
    again = [(t, s, p + 1_000_000) for t, s, p in rows]
    for more in ([], many, again):
        got, _ = judge(spark, rows + more)
        assert [got[i]["truncated"] for i in range(len(rows))] == [False] * 4 + [True] * 63
    assert all(got[len(rows) + i]["truncated"] == got[i]["truncated"] for i in range(len(rows)))


def test_lengths_of_odd_arrays():
    import pyarrow as pa

    from phasemill.llm.truncation import _classes

    texts = [None, "", "a\n" * 3_000_000, "é漢🙂\"", None, "x" * 10]
    whole = _classes(pa.array(texts))
    assert whole[:, 0].tolist() == [0, 0, 6_000_000, 10, 0, 10] and whole[2, 1] == 3_000_000
    assert (_classes(pa.array(texts).slice(2, 3)) == whole[2:5]).all() and _classes(pa.array([], pa.string())).shape == (0, 11)
