"""Personal data: base spans against plain patterns, disguises by exact source spans, special rows."""

import hashlib
import random
import re

import pytest

from clickscope.llm import pii

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _plain(kind, text):
    for m in re.finditer(PLAIN[kind], text):
        digits = re.sub(r"[^0-9]", "", m[0])
        if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "phone" and not 9 <= len(digits) <= 15:
            continue
        if kind == "card":
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            if not 13 <= len(digits) <= 19 or sum(d // 10 + d % 10 for d in twice) % 10:
                continue
        yield m.span()


@pytest.mark.parametrize("seed", range(40))
def test_base_spans_are_those_of_the_plain_patterns(seed):
    rng = random.Random(seed)
    bits = ["a", "b.c", "@", "@", ".", "-", "+", " ", "(", ")", "1", "22", "255", "300", "0004", "4111111111111111", "10.0.0.1", "%", "é", "x@y.z",
            "4111 1111-1111 1111", "+1 (202) 555-0187", "\n", "_"]
    text = "".join(rng.choice(bits) for _ in range(400))
    got = pii.spans_of(text)
    for kind in PLAIN:
        assert [(s, e) for k, s, e, base in got if k == kind and base] == list(_plain(kind, text)), kind


DISGUISED = [("email", "john dot smith at mail dot example dot com"), ("email", "a.b (at) example [dot] org"), ("email", "jo @ example.com"),
             ("email", "ｊｏ＠ｅxample．com"), ("email", "u​s​er@exa​mple.com"), ("email", "аnna@example.org"), ("email", "ana arroba correo punto es"),
             ("ip", "one nine two dot one six eight dot one dot one"), ("ip", "192[.]168[.]1[.]21"), ("ip", "١٩٢.168.1.1"),
             ("card", "four one one one one one one one one one one one one one one one"), ("card", "4l11 1111 1111 1111"),
             ("phone", "plus one, two zero two, five five five, one two three four"), ("phone", "+1 (202) 555–0187"),
             ("phone", "+vier neun drei null eins zwei drei vier fünf sechs")]


@pytest.mark.parametrize("kind,said", DISGUISED)
def test_disguises_are_found_at_their_source_characters(kind, said):
    text = "Früh ﻿- " + said + " und Ende"
    spans = [s for s in pii.spans_of(text) if s[0] == kind and not s[3]]
    assert spans, text
    start = text.index(said)
    assert (start, start + len(said)) in [(s, e) for _, s, e, _ in spans]
    assert pii.masked(text, spans) == "Früh ﻿- " + f"<{kind.upper()}>" + " und Ende"


@pytest.mark.parametrize("text", ["look at the polka dot dress", "one or two of three", "1999, 2000, 2001 and 555-4387 un", "meet me at example.com",
                                  "m² 10 at 3.5", "Grüße aus Köln, à bientôt", "a" * 50_000, "1" * 50_000, " " * 50_000, "@" * 50_000, "1." * 30_000 + "x",
                                  "at " * 20_000, "dot " * 20_000])
def test_plain_texts_gain_no_span(text):
    assert [s for s in pii.spans_of(text) if not s[3]] == []


def test_a_base_span_stays_beside_a_longer_disguised_one():
    text = "me@example.co dot uk"
    assert [(k, text[s:e], base) for k, s, e, base in pii.spans_of(text)] == [("email", "me@example.co", True), ("email", text, False)]
    assert pii.masked(text, pii.spans_of(text)) == "<EMAIL>"


def test_the_gate_lets_every_disguise_through():
    import pyarrow as pa
    import pyarrow.compute as pc
    said = [s for _, s in DISGUISED]
    for text, passed in zip(said, pc.match_substring_regex(pa.array(said), pii.GATE).to_pylist()):
        assert pii.spans_of(text, bool(passed)) == pii.spans_of(text), text


def test_tables_with_special_rows(spark):
    schema = "doc_id long, text string, pii_spans int, _in0 string, _spans string, `a b` int"
    text = "mail x@y.zz or +1 (202) 555-0187, jo (at) x dot org"
    rows = [(1, text, 1, "k", "s", 1), (1, text, 1, "k", "s", 1), (2, None, 1, None, None, None), (3, "", 1, "", "", 0), (None, text, 0, "", "", 0),
            (4, "1 " * 100_000, 0, "", "", 0)]
    docs = spark.createDataFrame(rows, schema)
    found = pii.find_personal_data(docs)
    assert found.columns == ["doc_id", "text", "_in0", "_spans", "a b", "pii_spans", "pii_masked"]
    got = {(r["doc_id"], r["text"]): r for r in found.collect()}
    assert got[1, text]["pii_masked"] == "mail <EMAIL> or <PHONE>, <EMAIL>" and got[1, text]["_in0"] == "k"
    assert got[2, None]["pii_spans"] == [] and got[2, None]["pii_masked"] is None and got[3, ""]["pii_masked"] == ""
    digests = sorted(pii.span_digests(docs).collect(), key=str)
    assert len(digests) == 6
    one = [r for r in digests if r["doc_id"] == 1]
    assert one[0] == one[1] and one[0]["spans"] == "email:5:11,email:34:51,phone:15:32" and one[0]["n_added"] == 1
    assert one[0]["base_sha256"] == hashlib.sha256(b"email:5:11,phone:15:32").hexdigest()
    assert (one[0]["n_email"], one[0]["n_phone"], one[0]["n_ip"], one[0]["n_card"]) == (1, 1, 0, 0)
    assert pii.span_digests(spark.createDataFrame([], schema)).collect() == []
