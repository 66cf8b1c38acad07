import random

from wordmill.llm import repair

from .test_grammar_phrases_runs import plain_tokens


def test_words_in_other_case_and_with_marks_are_encoded_once():
    encode = repair.Encoder(repair.tokenizer_path())
    texts = ["The the THE the, (the) the... Été été. ÉTÉ!"]
    assert [x.tolist() + [repair.END_ID] for x in encode(texts)] == plain_tokens(texts)
    assert set(encode.known) == {b"the", b",", b"(the)", b"...", "été".encode(), b".", b"!"}


def test_pieces_of_latin_letters_and_marks():
    pieces = ["a", "B", "é", "É", "ß", "×", "÷", "'", "s", "S", "9", ".", ",", "…", "ÿ", "Ÿ", "̱", "h", "H", "-", "re", "ll", "­", " ", "µ", "ª", "À", " ", "̸", "=", "đ", "<|endoftext|>", "<|ENDOFTEXT|>"]
    rng = random.Random(5)
    encode = repair.Encoder(repair.tokenizer_path())
    for n in range(300):  # an added token keeps the words of its slice whole
        texts = ["".join(rng.choices(pieces[: len(pieces) - 2 * (n % 3 > 0)], k=rng.randint(0, 40))) for _ in range(5)]
        assert [x.tolist() + [repair.END_ID] for x in encode(texts)] == plain_tokens(texts)
