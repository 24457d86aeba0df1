import random

import public_tokenizers

from starloom.llm import fertility
from tests.llm.cases import documents
from tests.llm.scripts import CLEAN

FILES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def kept(spark, texts):
    data = [(i, t, lang, "s", 0) for i, (t, lang) in enumerate(texts)]
    return {r.doc_id for r in fertility.keep(documents(spark, data), *FILES).collect()}


def test_clean_prose_of_every_script_is_kept(spark):
    texts = [(t, lang) for code, own in CLEAN.items() for t in (*own, " ".join(own)) for lang in (code, None)]
    assert kept(spark, texts) == set(range(len(texts)))


def test_junk_of_a_script_still_falls_out(spark):
    rng = random.Random(3)
    texts = []
    for own in CLEAN.values():
        phrase = " ".join(own).split()[:9]
        texts.append((" ".join(" ".join(rng.sample(phrase, 9)) for _ in range(30)), None))
    for code in ("ru", "uk", "el", "ar", "he", "vi"):
        letters = sorted(set(" ".join(CLEAN[code])) - set(" .,"))
        texts.append((" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(120)), code))
    for code in ("ru", "uk", "el", "vi"):
        texts.append((" ".join(CLEAN[code]).upper(), code))
    # a few letters don't make a salad of signs a text of their script
    texts.append((" ".join("".join(rng.choice("#*$%&|<>@^~я") for _ in range(6)) for _ in range(60)), "ru"))
    assert not kept(spark, texts)


def test_dominant_script():
    got = {code: {fertility.script(t.encode()) for t in own} for code, own in CLEAN.items()}
    want = {"ru": "cyrillic", "uk": "cyrillic", "el": "greek", "ar": "arabic", "he": "hebrew", "hi": "devanagari", "ko": "hangul",
            "zh": "han", "th": "thai", "vi": "marked", "pl": "", "cs": "", "tr": "", "it": ""}
    assert all(got[code] == {name} for code, name in want.items()) and got["ja"] <= {"kana", "han"}
    assert [fertility.script(x.encode()) for x in ("", "  ", "a б", "a бв", "123 #$", "বাংলা")] == ["", "", "", "cyrillic", "", "rest"]
