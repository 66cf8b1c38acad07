import random
import re
import string

from wordmill.llm import pii


def spans(text):
    out = set()
    for tokens, held in pii.stretches(text):
        out |= {(tokens[i][0], tokens[j - 1][1]) for i, j in pii.candidates(text, tokens, held)}
    return out


def test_every_gold_span_is_a_candidate():
    for text, gold in pii.training_sentences(1500, 77):
        got = spans(text)
        assert all((a, b) in got for a, b, _ in gold), (text, gold)


def sparse_key(r, n):
    """A base62 key without two digits side by side."""
    while True:
        key = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(n))
        if not re.search("[0-9]{2}", key) and re.search("[0-9]", key):
            return key


def test_keys_without_adjacent_digits_are_found():
    r, model, found = random.Random(5), pii.trained(), 0
    for k in range(60):
        key = sparse_key(r, (24, 32, 40)[k % 3])
        text = f"there is no other way, so {('token = ', 'apikey = ', 'password = ')[k % 2]}\"{key}\" is what they took"
        assert (text.index(key), text.index(key) + len(key)) in spans(text)
        assert (0, len(key)) in spans(key + " stands alone")
        found += (text.index(key), text.index(key) + len(key), "secret") in pii.model_spans(model, text)
    assert found >= 54


def test_letters_after_a_cue_and_written_mail_are_candidates():
    for text, part in (
        ('password = "correcthorse" and so on', "correcthorse"), ("API_KEY: QwErTyUiOpAsDfGh", "QwErTyUiOpAsDfGh"), ("Bearer abcdefghij", "abcdefghij"),
        ("password: token=abcdef", "abcdef"), ("jo at mail dot io", "jo at mail dot io"), ("jo at mail dot example dot de now", "jo at mail dot example dot de"),
    ):
        assert (text.index(part), text.index(part) + len(part)) in spans(text), text
