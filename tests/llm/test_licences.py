import re

import pytest

from clickloom.llm.licences import EVERY, LOWER, NOTICES, PHRASES, STATEMENTS, UPPER, Template, scan
from samples import SCHEMA

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def base(text):
    words = re.findall(WORDS, (text or "").translate(str.maketrans(UPPER, LOWER)))
    places = [
        (i, t.label) for t in PHRASES for i in range(len(words)) if words[i : i + len(t.text.split())] == t.text.split()
    ]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_phrases_equal_brute_force(spark, docs, empty):
    texts = [
        "CC-BY cc by; Cc By", "all rights reserved ALL RIGHTS RESERVED all rights", "general public licenSe", "GNU General\nPublic\tLicense",
        "Kcc by", "cc bÿ", "ccby cc", "x", "cc by " * 300, "all all rights reserved reserved", "éall rights reserved",
    ]
    rows = spark.createDataFrame([(100 + i, t, None, None) for i, t in enumerate(texts)], SCHEMA)
    for df in (rows, docs):
        got = sorted([tuple(r)[:6] for r in scan(df, PHRASES + NOTICES).collect()], key=str)
        assert got == sorted([(r[0], *base(r[1])) for r in df.collect()], key=str)
    assert scan(empty, PHRASES).count() == 0


def edited(text):
    """The notice with another case and layout, some words dropped and some added."""
    words = text.upper().split()
    del words[20:22]
    words[40:40] = ["INSERTED", "WORDS"]
    return "\n".join(words)


@pytest.mark.parametrize("i", range(len(NOTICES)))
def test_notices_are_found_where_they_stand(spark, i):
    notice = NOTICES[i]
    text = "before " * 30 + (edited(notice.text) if len(notice.text.split()) > 45 else notice.text) + " behind" * 30
    row = scan(spark.createDataFrame([(1, text), (2, "other words " * 50)], "doc_id long, text string"), NOTICES).orderBy("doc_id").collect()
    span = max(row[0].spans, key=lambda s: s.share)
    assert span.label == notice.label and 0.6 <= span.share <= 1 and row[0].n_base == 0
    assert abs(span.start - 30) <= 2 and abs(span.end - (row[0].n_words - 30)) <= 3
    assert row[1].labels == "" and row[1].score == 0.0 and row[1].spans == []


def base_labels(*texts):
    return {x for t in texts for x in base(t)[4].split(",") if x}


def test_each_notice_gives_its_label_alone(spark):
    """Also the notices of one family, which share most of their words, and whole or edited."""
    texts = [t.text for t in NOTICES] + [edited(t.text) for t in NOTICES if len(t.text.split()) > 45]
    names = [t.label for t in NOTICES] + [t.label for t in NOTICES if len(t.text.split()) > 45]
    rows = spark.createDataFrame([(i, "of the " + t + " and to it") for i, t in enumerate(texts)], "doc_id long, text string")
    for templates in (PHRASES + NOTICES, EVERY):
        got = {r.doc_id: r.labels for r in scan(rows, templates).collect()}
        assert got == {i: ",".join(sorted({name} | base_labels(texts[i]))) for i, name in enumerate(names)}


def test_two_notices_give_both_labels(spark):
    pairs = [(a, b) for a in NOTICES for b in NOTICES if a is not b]
    rows = [(i, f"{a.text}. Some words stand between the two of them. {b.text}") for i, (a, b) in enumerate(pairs)]
    got = {r.doc_id: r.labels for r in scan(spark.createDataFrame(rows, "doc_id long, text string"), EVERY).collect()}
    assert got == {i: ",".join(sorted({a.label, b.label} | base_labels(a.text, b.text))) for i, (a, b) in enumerate(pairs)}


def test_common_pairs_of_words_do_not_vote_for_notices(spark):
    words = NOTICES[1].text.split()
    pairs = " x ".join(" ".join(words[i : i + 2]) for i in range(len(words)))
    row = scan(spark.createDataFrame([(1, pairs)], "doc_id long, text string"), NOTICES).first()
    assert row.labels == "" and row.score == 0


def test_short_templates_are_refused(spark, docs):
    with pytest.raises(ValueError, match="at least"):
        scan(docs, [Template("x", "one")])


def test_one_line_statements_name_their_licence(spark):
    lines = {
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "Licensed under CC BY-NC 4.0.": "cc-by,cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "All rights reserved.": "reserved",
        "License: BSD 3-Clause": "bsd",
        "GNU Lesser General Public License": "gpl,lgpl",
        "GNU Affero General Public License v3": "agpl,gpl",
        "Mozilla Public License, Version 2.0": "mpl-2.0",
        "Creative Commons Attribution-ShareAlike 4.0": "cc-by-sa",
        "CC0 1.0 Universal": "cc0",
        "Apache Junction has a public license office, version 2.0 of it": "",
        "the license of MIT": "",
    }
    rows = spark.createDataFrame([(i, f"before it {line} and behind", None, None) for i, line in enumerate(lines)], SCHEMA)
    got = {r.doc_id: (r.labels, r.score) for r in scan(rows, PHRASES + NOTICES + STATEMENTS).collect()}
    assert got == {i: (labels, 1.0 if labels else 0.0) for i, labels in enumerate(lines.values())}


def test_statements_leave_phrases_and_notices_as_they_are(spark, docs):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    few, all_ = (scan(docs, t).select(columns).collect() for t in (PHRASES + NOTICES, PHRASES + NOTICES + STATEMENTS))
    assert sorted(map(tuple, few), key=str) == sorted(map(tuple, all_), key=str)
