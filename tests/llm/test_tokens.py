import pyarrow as pa
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from clickloom.llm.tokens import Encoder
from samples import TOKENIZER

with open(TOKENIZER, encoding="utf-8") as file:
    SPEC = file.read()
PLAIN = Tokenizer.from_str(SPEC)
CHUNKED = Encoder(SPEC, 0)
PIECES = st.sampled_from(
    [" ", "  ", "\n", "\t", "\r\n", " ", "　", "\x1c", "\x85", "a", "Word", "don't", "'s", "é", "ß", "12", "٣", "²", "!?", "...",
     "<|endoftext|>", "😀", "́", "中文", "_", "\x00", "l'ê"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(PIECES, max_size=12).map("".join), st.text(max_size=20)), min_size=1, max_size=5))
def test_chunks_give_the_ids_of_whole_texts(texts):
    ids, ends = CHUNKED.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert ids[ends[i] : ends[i + 1]].tolist() == [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]
