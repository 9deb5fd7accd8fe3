from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers

from salesloom.llm import common, fertility

TOOLS = (public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def base(text):
    words = text.encode().split()
    counts = Counter(zip(words, words[1:], words[2:]))
    inside = [any(counts[tuple(words[j : j + 3])] > 1 for j in range(max(0, k - 2), k + 1) if j + 3 <= len(words)) for k in range(len(words))]
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            again += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), again, sum(inside))


def verdicts(spark, rows, schema="doc_id bigint, text string, lang string, kept string"):
    return fertility.verdicts(spark.createDataFrame(rows, schema), *TOOLS)


def test_base_figures_equal_plain_python(spark):
    common.prepared(spark)
    chance = random.Random(9)
    parts = ["a", "b", "é", "\n", "a b c", "*|", " ", "\t", " x", "😀", "\x0b", "\n\n", "c"]
    rows = [(k, "".join(chance.choice(parts) + chance.choice([" ", "", "\n"]) for _ in range(chance.randint(0, 60))), "en", "x") for k in range(300)]
    rows += [(900, "", "en", "x"), (901, "a b c a b c", None, "x")]
    texts = {r[0]: r[1] for r in rows}
    for r in verdicts(spark, rows).collect():
        want = base(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_many_different_words_take_the_second_path():
    words = [b"%d" % (k % 50) for k in range(200)]
    want = fertility.repeated_words(words)
    assert want == base(b" ".join(words).decode())[4]


def test_odd_texts_leave_the_bands(spark):
    common.prepared(spark)
    chance = random.Random(2)
    words = "the of and was people there which other about number water called who sound words first most very after".split()
    rows = [(k, " ".join(chance.choice(words) for _ in range(120)), "en", "x") for k in range(260)]
    rows.append((900, " ".join(chance.choice(words).upper()[::-1] + "!!" for _ in range(120)), "en", "x"))
    found = {r["doc_id"]: r for r in verdicts(spark, rows).collect()}
    assert not found[900]["kept"] and "token" in found[900]["reason"]
    assert sum(found[k]["kept"] for k in range(260)) >= 255


def test_verdicts_of_a_small_clean_group_stay(spark):
    common.prepared(spark)
    chance = random.Random(4)
    english = "the of and was people there which other about number water called who sound words first most very after".split()
    polish = "że się książka również wszystko człowiek między które będzie żeby szczęście źródło dzień łąka świat trzeba".split()
    greek = "και το βιβλίο είναι άνθρωπος μεταξύ κόσμος ημέρα πηγή ευτυχία όταν πρέπει νερό θάλασσα λέξη φωνή".split()

    def made(first, n, words, lang):
        return [(first + k, " ".join(chance.choice(words) for _ in range(chance.randint(90, 150))), lang, "x") for k in range(n)]

    small = made(1000, 60, polish, "pl") + made(2000, 12, greek, "el") + made(3000, 4, greek, None)
    alone = {r["doc_id"]: r["kept"] for r in verdicts(spark, small).collect()}
    among = {r["doc_id"]: r["kept"] for r in verdicts(spark, small + made(0, 400, english, "en")).collect()}
    assert all(alone.values())
    assert all(among[k] for k in alone)


def test_entropy_share():
    assert fertility.entropy_share(np.array([1])) == 1.0
    assert fertility.entropy_share(np.array([1, 1, 1, 1])) == 0.0
    assert abs(fertility.entropy_share(np.array([1, 2, 3, 4])) - 1.0) < 1e-12


def test_scripts():
    assert [fertility.script_of(t) for t in ("abc", "где", "漢字 a", "12", "")] == ["latin", "cyrillic", "han", "none", "none"]


def test_nulls_repeated_rows_and_empty_table(spark):
    common.prepared(spark)
    rows = [(1, None, None, "x"), (None, "a b", "en", "x"), (2, "a b", "en", "x"), (2, "a b", "en", "x")]
    found = verdicts(spark, rows).collect()
    assert len(found) == 4 and not any(r["kept"] for r in found)
    assert verdicts(spark, rows).limit(0).count() == 0
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert fertility.verdicts(empty, *TOOLS).count() == 0


def test_segments_encode_as_whole_texts():
    import base64

    import sentencepiece
    import tiktoken

    library = sentencepiece.SentencePieceProcessor(model_file=TOOLS[0])
    with open(TOOLS[1], "rb") as file:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, file)}
    whole = tiktoken.Encoding("plain", pat_str=TOOLS[2], mergeable_ranks=ranks, special_tokens={})
    chance = random.Random(12)
    parts = ["a", "It's", " ", "  ", "\n", "\n\n", "\t", "é", "▁", "漢字", "\x1c", "\x85", "\u00a0", "don't!", "12,5", "😀", "'ll", "\u3000", "word", "...", "\x0b"]
    texts = ["".join(chance.choice(parts) for _ in range(chance.randint(0, 30))) for _ in range(3000)] + ["", " ", "▁", "  a", "x" * 5000, "long word " * 30_000]
    tools = fertility.Vocabularies(*TOOLS)
    assert tools.alone and tools.spaced
    for text, (ids, others) in zip(texts, tools.encoded(texts)):
        assert ids.tolist() == library.encode(text), repr(text)
        assert others == len(whole.encode_ordinary(text)), repr(text)
    other = fertility.Vocabularies(TOOLS[0], TOOLS[1], r"\S+|\s+")
    assert not other.spaced and next(other.encoded(["a b"]))[0].tolist() == library.encode("a b")
