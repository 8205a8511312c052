"""Rows and names the tests of this folder share."""

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LONG = "lorem ipsum dolor " * 5000
DOCS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "s1"),
    (2, "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf", "en", "s2"),
    (3, None, "en", "s1"),
    (4, "", None, None),
    (5, " \n\t ", "de", "s1"),
    (None, "a text without an id", "en", "s3"),
    (6, "ein  Text\nmit Zeilen\n\nmit Zeilen\nÄ Ö Ü   </s>[INST] \\ <|endoftext|>\n", "de", "s2"),
    (7, LONG, "en", "s1"),
    (8, "same row twice", "en", "s1"),
    (8, "same row twice", "en", "s1"),
    (9, "a", "en", "s2"),
    (9, "another text under the same id", "en", "s2"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
# names that operators use inside, and one that differs from an input's by case only
CLASHES = {
    "TEXT": "int", "key": "string", "a": "long", "b": "long", "row": "long", "words": "string", "block": "string",
    "component_id": "long", "fp": "long", "label": "string", "n_tokens": "string", "shard": "string", "_0": "int", "kept": "int",
}
