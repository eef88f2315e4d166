import hashlib
import re

import pytest
from helpers import documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from silverline.llm import pii


def plain(text):
    out = {k: [] for k in pii.KINDS}
    out["email"] = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out["ip"] = [(m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c in "0123456789"]
        doubled = [d if n % 2 == 0 else sum(divmod(2 * d, 10)) for n, d in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0:
            out["card"].append((m.start(), m.end()))
    out["phone"] = [(m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return ",".join(f"{k}:{a}:{b}" for k in pii.KINDS for a, b in out[k])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a@.-+%_1240 59()é١\n", max_size=60))
def test_base_is_that_of_the_patterns(text):
    assert pii.joined(pii.base_spans(text)) == plain(text)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jane [at] example [dot] com now", "email", "jane [at] example [dot] com"),
        ("é jane.doe at mail dot example dot org.", "email", "jane.doe at mail dot example dot org"),
        ("jane(at)example.com", "email", "jane(at)example.com"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("ja​ne@exam​ple.com", "email", "ja​ne@exam​ple.com"),
        ("jane＠example．com", "email", "jane＠example．com"),
        ("call plus one three one zero five five five four five one zero today", "phone", "plus one three one zero five five five four five one zero"),
        ("ip 192 dot 168 dot 0 dot 12!", "ip", "192 dot 168 dot 0 dot 12"),
        ("vier eins eins eins 1111 eins eins eins eins eins eins eins eins", "card", "vier eins eins eins 1111 eins eins eins eins eins eins eins eins"),
        ("４１１１ １１１１ １１１１ １１１１", "card", None),
    ],
)
def test_disguises(text, kind, found):
    base, more = pii.all_spans(text)
    assert [k for k, *_ in more] == [kind] and not [s for s in base if s[0] == kind]
    if found:
        assert text[more[0][1] : more[0][2]] == found


@pytest.mark.parametrize("text", ["we met at noon dot the end", "one two three", "look at this dot", "at at dot dot", "sept un deux", "[at] (dot) {at}"])
def test_prose_stays_clean(text):
    assert pii.all_spans(text) == ([], [])


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("host one nine two dot one six eight dot zero dot one is up", "ip", "one nine two dot one six eight dot zero dot one"),
        ("at One-Two-Seven dot 0 dot zero DOT eins, now", "ip", "One-Two-Seven dot 0 dot zero DOT eins"),
        ("call six one two three one nine two dot 168 dot five dot 12!", "ip", None),
        ("mail jane at example dot se today", "email", "jane at example dot se"),
        ("jane.doe at post dot example dot AT", "email", "jane.doe at post dot example dot AT"),
    ],
)
def test_short_runs_and_any_country(text, kind, found):
    base, more = pii.all_spans(text)
    assert base == [] and [k for k, *_ in more] == [kind]
    assert found is None or text[more[0][1] : more[0][2]] == found
    assert pii.masked_text(text) == text[: more[0][1]] + f"[{kind.upper()}]" + text[more[0][2] :]


@pytest.mark.parametrize("text", ["one dot two dot three", "three hundred dot one dot two dot", "nine nine nine dot one dot two dot three", "we met at noon dot the end", "someone dot one dot two dot onerous"])
def test_other_dots_stay(text):
    assert pii.all_spans(text) == ([], [])


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("call +49 170 123 45 six seven eight nine now", "phone", "+49 170 123 45 six seven eight nine"),
        ("call plus four nine 170 1234567 now", "phone", "plus four nine 170 1234567"),
        ("mail jane at example\ndot com ok", "email", "jane at example\ndot com"),
        ("at 10 dot 0\ndot zero dot one two, ok", "ip", "10 dot 0\ndot zero dot one two"),
        ("pay 4111 1111 eins eins eins eins\n1111 now", "card", "4111 1111 eins eins eins eins\n1111"),
        ("jane@example.com dot mx soon", "email", "jane@example.com dot mx"),
    ],
)
def test_longer_than_the_base_and_over_lines(text, kind, found):
    base, more = pii.all_spans(text)
    spans = [text[a:b] for k, a, b in more if k == kind]
    assert spans == [found]
    masked = pii.masked_text(text)
    assert masked == text.replace(found, f"[{kind.upper()}]")
    assert all(f"{k}:{a}:{b}" in pii.joined(base + more).split(",") for k, a, b in base)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["one", "zwei", "plus", "3", "47", "170", ",", "-", " ", " ", "\n", "x", "dot", "at", "@", ".", "+"]), max_size=30))
def test_masked_text_leaves_nothing_of_a_finding(parts):
    text = "".join(parts)
    base, more = pii.all_spans(text)
    covered = {i for _, a, b in base + more for i in range(a, b)}
    rest = "".join(c for i, c in enumerate(text) if i not in covered)
    assert re.sub(r"\[(EMAIL|IP|CARD|PHONE)\]", "", pii.masked_text(text) or "") == rest


def test_one_name_after_a_number_is_a_word():
    assert pii.masked_text("tel. +1 (848) 555-1373 Un jour") == "tel. [PHONE] Un jour"


def test_masking():
    assert pii.masked_text("a@b.co and +1 (310) 555-4510, jane [at] x [dot] org") == "[EMAIL] and [PHONE], [EMAIL]"
    assert pii.masked_text(None) is None and pii.masked_text("") == "" and pii.masked_text("plain") == "plain"


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "a@" * 100_000, "one " * 50_000, "x dot " * 50_000, " at " * 80_000):
        pii.all_spans(text)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in pii.digest(pii.find_personal_data(docs)).collect()}
    for doc in docs.collect():
        expected, r = plain(doc.text or ""), rows[doc.doc_id]
        assert r.spans == expected and r.base_sha256 == hashlib.sha256(expected.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(re.findall(f"{k}:", expected)) for k in pii.KINDS)


def test_odd_rows(spark):
    rows = [*odd_rows(), (9, "x " * 100_000 + "a@b.co", "a")]
    docs = documents(spark, rows)
    found = pii.digest(pii.find_personal_data(docs)).collect()
    assert len(found) == len(rows)
    assert [r.spans for r in found if r.spans] == ["email:200000:200006"]
    masked = pii.mask_personal_data(docs)
    assert masked.columns == docs.columns
    texts = [(r.doc_id, r.text, r.n_chars) for r in masked.collect()]
    assert (9, "x " * 100_000 + "[EMAIL]", 200_007) in texts and (4, None, 0) in texts
    assert pii.find_personal_data(documents(spark, [])).collect() == []
