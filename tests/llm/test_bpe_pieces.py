import random

import numpy as np

from envstream.llm.bpe import ChunkedBpe, model_path

PARTS = ["the", "Été", "straße", "ƻ", "ª", "漢", ".", "!?", "'s", "'", "-", "1", "\n", "\n", " ", " ",
         " ", "\t", "᠎", "\x1c", "_", "\x7f", "<|endoftext|>", "<|"]


def test_words_go_to_the_model_and_the_rest_to_the_library():
    from tokenizers import Tokenizer

    library, model = Tokenizer.from_file(model_path()), ChunkedBpe(model_path(), cache=30)
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 20))) for _ in range(4000)]
    for text, data in zip(texts, model.encode(texts)):
        assert np.frombuffer(data, np.uint32).tolist() == library.encode(
            text, add_special_tokens=False).ids, text


def test_plain_words_take_no_run_of_the_whole_library():
    model, sent = ChunkedBpe(model_path()), []

    class Counted:
        def __init__(self, library):
            self._library = library

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return self._library.encode_batch_fast(texts, **options)

    library = model._library
    model._library = Counted(library)
    text = "Anblewh sttible, thonre.\nWas Été straße!!\nand x-y 12"
    data, = model.encode([text])
    assert np.frombuffer(data, np.uint32).tolist() == library.encode(
        text, add_special_tokens=False).ids
    assert sorted(sent) == [" 12", " x-y"]
