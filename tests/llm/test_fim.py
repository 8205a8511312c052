import hashlib
import io
import random
import re

import pytest
import zstandard

from clickloom.llm import fim, files


def expected(doc_id, text):
    """(doc_id, n, form, prefix, middle, output) from the definition."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 50:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def digested(rows):
    sha = lambda x: hashlib.sha256((x or "").encode()).hexdigest()
    return sorted(((*e[:5], sha(e[5]), sha(text)) for d, text in rows for e in [expected(d, text)]), key=str)


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def messy_texts(n, seed):
    draw = random.Random(seed)
    pieces = ["a", "\n", "\n\n", "ä€😀", "<", "<P", "S>", "M", " ", "\r", "word " * 9]
    return [(i, "".join(draw.choice(pieces) for _ in range(draw.randrange(0, 40)))) for i in range(n)]


def test_messy_rows_equal_brute_force(docs, empty):
    rows = [(r[0], r[1]) for r in docs.collect()]
    assert sorted(map(tuple, fim.round_trip(docs.repartition(3)).collect()), key=str) == digested(rows)
    assert fim.round_trip(empty).count() == 0


@pytest.mark.parametrize("frame_bytes", [1, 7, 64])
def test_texts_over_many_frames_equal_brute_force(spark, frame_bytes):
    rows = [*messy_texts(150, frame_bytes), (900, "x<P>y"), (901, "<S>"), (902, "one line <M"), (903, "\n"), (904, "no end" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    written = fim.write_texts(docs, files.new_folder(spark, "texts"), frame_bytes=frame_bytes)
    assert sorted(map(tuple, fim.digests(written).collect()), key=str) == digested(rows)
    got = {r.doc_id: (r.form, r.output) for r in fim.outputs(written).collect()}
    assert got == {d: (e[2], e[5]) for d, text in rows for e in [expected(d, text)]}
    assert {form for form, _ in got.values()} == {"plain", "psm", "spm"}


def test_a_cut_decompresses_one_frame_and_any_reader_sees_the_text():
    out = io.BytesIO()
    writer = fim.TextWriter(out, [b"<P>"], frame_bytes=100)
    raw = b"".join(f"line number {i}\n".encode() for i in range(1000)) + "Ende ä".encode()
    writer.add(None, b"first\n")
    writer.add(5, raw)
    writer.close()
    file = fim.TextFile(Memory(out.getvalue()))
    text, opened, frame = file.text(1), [], file.frame
    file.frame = lambda i: opened.append(i) or frame(i)
    assert text.n_units == 1001 and text.n_chars == len(raw.decode())
    for unit in (0, 1, 6, 500, 1000, 1001):
        opened.clear()
        whole = b"".join(raw.splitlines(keepends=True)[:unit])
        assert text.cut(unit) == (len(whole), len(whole.decode())) and len(opened) <= 1
    assert b"".join(text.stream(50, 777)) == raw[50:777]
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.getvalue()), read_across_frames=True)
    assert reader.read() == b"first\n" + raw


def test_outputs_without_their_marks_are_refused():
    with pytest.raises(ValueError):
        list(fim.sections(iter([b"x<P>"]), [b"<P>", b"<S>", b"<M>"]))
    with pytest.raises(ValueError):
        list(fim.sections(iter([b"<P>", b"a<S", b">b"]), [b"<P>", b"<S>", b"<M>"]))


def test_share_of_moved_documents_is_a_parameter(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "'a\nb\nc' AS text")
    forms = [r.form for r in fim.round_trip(docs, fim.Fim(share=50, spm=0)).collect()]
    assert 100 < forms.count("plain") < 200 and forms.count("psm") == 300 - forms.count("plain")
