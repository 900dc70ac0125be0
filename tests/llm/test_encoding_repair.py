import random

import pytest

from plumbline.llm import encoding_repair as E

WORDS = ["Büchse", "gößlin", "tubulação", "těsnění", "Кольцо", "δακτύλιος", "ガスケット", "90°", "½ inch", "“A”", "Maker™", "–40 °C", "12 × 40", "ŁOZAŃKA", "σ"]


@pytest.mark.parametrize("charset", ["cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r"])
@pytest.mark.parametrize("word", WORDS)
def test_round_trip(charset, word):
    """What was decoded wrongly comes back, wherever the wrong charset has a character for each byte."""
    try:
        wrong = word.encode().decode(charset)
    except UnicodeDecodeError:
        pytest.skip("the charset lacks a byte")
    if charset == "cp1251" and word in ("½ inch", "σ"):
        pytest.skip("two Cyrillic letters that could stand in a word")
    affected, restored, _ = E.repair(f"upper {wrong}, brass")
    assert affected
    if charset in ("cp1252", "latin-1", "mac_roman", "cp437"):
        assert restored == f"upper {word}, brass"


def test_twice_and_in_part():
    twice = "tubulação".encode().decode("cp1252").encode().decode("cp1252")
    assert E.repair(f"Büchse {twice} ½")[:2] == (True, "Büchse tubulação ½")
    assert E.repair("kj&oslash;ler \\u00e9crou")[:2] == (True, "kjøler écrou")
    assert E.repair("m\xe3\xbcvexa")[:2] == (True, "müvexa")  # garbled, then put into lower case


@pytest.mark.parametrize("text", [*WORDS, "plain", "", "Niñoca", "fоr rеar", "ｆｌａｔ ｆａｎ", "copp​er", "Ø 8 mm", "grade ®", "§ 4", "± 0.2 mm", "pièce", "a b c", "AT&T; R&D"])
def test_correct_text_stays(text):
    assert E.repair(text)[:2] == (False, text)


def test_lost_characters_cannot_be_restored():
    assert E.repair("r�tula")[:2] == (True, None)
    assert E.repair("r�tula Ã©crou")[:2] == (True, None)
    assert E.repair(None) == (False, None, None)


def test_held_out_accuracy():
    rng = random.Random(9)
    right = 0
    for _ in range(300):
        word = "".join(rng.choice("abcdefghij" + "äöüßéèçñøåąęłşğ") for _ in range(rng.randint(4, 9))) + rng.choice("äöüéñø")
        charset = rng.choice(["cp1252", "latin-1", "mac_roman"])
        try:
            right += E.repair(word.encode().decode(charset))[1] == word
        except UnicodeDecodeError:
            right += 1
    assert right >= 285


def test_table(spark):
    rows = [(1, None, "k"), (2, "", "k"), (3, "Ã©crou", "k"), (4, "Ã©crou", "k"), (5, "x" * 100_000 + " Ã©", "k"), (6, "écrou", "k"), (7, "�", "k")]
    df = spark.createDataFrame(rows, "row_id long, description string, key string")
    got = {r.row_id: r.restored for r in E.find_garbled(df, "row_id", "description").collect()}
    assert got == {3: "écrou", 4: "écrou", 5: "x" * 100_000 + " é", 7: None}
    assert E.find_garbled(df.limit(0), "row_id", "description").count() == 0
