import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickloom.llm.packing import Limits, Piece, pack, place, power_of_two
from samples import TOKENIZER


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 300), st.integers(0, 40)), max_size=60),
    st.sampled_from([Limits(64, 8, 64), Limits(64, 3, 40), Limits(100, 100, 100), Limits(32, 1, 32)]),
)
def test_pieces_cover_every_example_within_all_limits(examples, limits):
    done, rest = place([Piece(i, 0, n, free) for i, (n, free) in enumerate(examples)], limits, last=True)
    assert not rest
    spans = defaultdict(list)
    for sequence in done:
        size = sum(p.length for p in sequence)
        assert size == limits.tokens or power_of_two(size)
        assert size <= limits.tokens and len(sequence) <= limits.segments and sum(p.loss() for p in sequence) <= limits.loss
        for p in sequence:
            spans[p.item].append((p.start, p.length))
    for i, (n, _) in enumerate(examples):
        at = 0
        for start, length in sorted(spans[i]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_examples_that_fit_together_are_not_cut():
    done, _ = place([Piece(i, 0, n, 0) for i, n in enumerate([60, 40, 70, 30, 50, 50])], Limits(100, 4, 100), last=True)
    assert sorted(sorted(p.item for p in s) for s in done) == [[0, 1], [2, 3], [4, 5]]


def test_messy_rows_equal_direct_encoding(docs, empty):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = pack(docs, TOKENIZER, with_ids=True).collect()
    expected = sorted((str(r[0]), *tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0) for r in docs.collect())
    texts, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length
        texts[(str(r.doc_id), r.doc_tokens)].append(r)
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or power_of_two(at)
    # rows that repeat an id and a length are told apart by their ids only
    got = sorted(
        (name, *np.frombuffer(b"".join(r.ids for r in sorted(pieces, key=lambda r: r.start)), "<u4").tolist())
        for (name, n), pieces in texts.items()
        if sum(r.length for r in pieces) == n
    )
    assert set(got) <= set(expected) and sum(r.length for r in rows) == sum(len(e) - 1 for e in expected)
    assert pack(empty, TOKENIZER).count() == 0


def test_prompts_bear_no_loss_and_the_loss_limit_decides(spark):
    """Instruction data: a third of each example bears loss, and sequences hold far more tokens than loss."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    rows = [(i, "please answer this question about number " + "x " * (5 + i % 11) + str(i), "the answer " * (2 + i % 7) + str(i)) for i in range(300)]
    rows += [(300, None, "no prompt at all"), (301, "only a prompt", None), (301, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, question string, text string").coalesce(1)
    limits = Limits(tokens=512, segments=64, loss=96)
    prompts = [len(tokenizer.encode(q or "", add_special_tokens=False).ids) for _, q, _ in rows]
    ids = [[*tokenizer.encode(q or "", add_special_tokens=False).ids, *tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for _, q, t in rows]
    free = {(i, len(x)): n for (i, _, _), x, n in zip(rows, ids, prompts)}
    got = pack(docs, TOKENIZER, limits, with_ids=True, prompt="question").collect()
    sequences, texts = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append(r)
        texts[r.doc_id, r.doc_tokens].append(r)
    loss = lambda r: max(0, r.start + r.length - max(r.start, free[r.doc_id, r.doc_tokens]))
    sums = [(sum(r.length for r in s), len(s), sum(map(loss, s))) for s in sequences.values()]
    assert all(t <= 512 and n <= 64 and x <= 96 for t, n, x in sums)
    # the loss of full sequences is spent to the last token
    assert sum(x == 96 for _, _, x in sums) > len(sums) / 10
    whole = {k: np.frombuffer(b"".join(r.ids for r in sorted(v, key=lambda r: r.start)), "<u4").tolist() for k, v in texts.items()}
    assert whole == {(i, len(x)): x for (i, _, _), x in zip(rows, ids)}
    # without that limit fewer, fuller sequences hold the same examples
    free_loss = pack(docs, TOKENIZER, Limits(tokens=512, segments=64, loss=512), prompt="question")
    assert free_loss.select("sequence_id").distinct().count() < len(sequences)
