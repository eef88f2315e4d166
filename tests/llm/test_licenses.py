import re

import pytest
from helpers import documents, odd_rows

from silverline.llm import licenses


def base_by_pattern(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def scan(spark, texts):
    rows = licenses.scan_licenses(documents(spark, [(i, t, "a") for i, t in enumerate(texts)])).collect()
    return [r for r in sorted(rows, key=lambda r: r.doc_id)]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    own = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0"}
    own["This work is licensed under the GNU General Public License, version 3."] = "gpl-3.0"
    for doc in docs.collect():
        r = rows[doc.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base_by_pattern(doc.text)
        expected = {label for line, label in own.items() if line.lower() in (doc.text or "").lower()} | set(filter(None, r.base_labels.split(",")))
        assert expected <= set(r.labels.split(",")) | {""} and (r.labels != "") == bool(expected)
        assert (r.score > 0) == bool(expected) and r.score <= 1


@pytest.mark.parametrize("label", [k for k, texts in licenses.TEMPLATES.items() for _ in texts[:1]])
def test_every_notice_is_found_in_a_text(spark, label):
    (r,) = scan(spark, [f"some words before {licenses.TEMPLATES[label][0].upper()} and some after"])
    assert label in r.labels.split(",")


def test_edits_and_look_alikes(spark):
    notice = licenses.TEMPLATES["mit"][2].split()
    left_out = " ".join(notice[:7] + notice[8:])
    put_in = " ".join(notice[:9] + ["truly"] + notice[9:])
    replaced = " ".join(notice[:5] + ["libre"] + notice[6:])
    halved = " ".join(notice[: len(notice) // 2])
    found = scan(spark, [left_out, put_in, replaced, halved, "Licensed under the Apache Lizenz", "x " * 3000 + put_in + " y" * 3000, "licensed under cc by 4.0"])
    assert [r.labels for r in found] == ["mit", "mit", "mit", "", "", "mit", "cc-by,cc-by-4.0"]
    assert found[1].score == 1.0 and 0.8 <= found[0].score < 1


def test_many_words_put_in_or_left_out_at_one_place(spark):
    notice = licenses.TEMPLATES["mit"][2]
    reworded = notice.replace("this software", "the Foo Bar Baz library version 2")
    words = notice.split()
    left_out = " ".join(words[:8] + words[13:])
    spoiled = " ".join(w + " indeed" * (i % 3 == 2) for i, w in enumerate(words))
    scattered = " ".join(w + " x" * 20 for w in words)
    found = scan(spark, [reworded, "x " * 2000 + reworded + " y" * 2000, left_out, spoiled, scattered, f"{reworded} and {notice}"])
    assert [r.labels for r in found] == ["mit", "mit", "mit", "mit", "", "mit"]
    assert found[0].score == pytest.approx(25 / 27) and found[2].score == pytest.approx(22 / 27) and found[3].score == 1.0


def test_odd_rows(spark):
    rows = [*odd_rows(), (9, "Cc By cc by CC-BY", None), (9, "Cc By cc by CC-BY", None)]
    found = licenses.scan_licenses(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    key = lambda x: str(x)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=key) == sorted(((i, *base_by_pattern(t)) for i, t, _ in rows), key=key)
    assert licenses.scan_licenses(documents(spark, [])).collect() == []
