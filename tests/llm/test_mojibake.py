import pytest

from clipwright.llm.mojibake import repair, restored
from tests.conftest import rows

TEXT = "Gördüğün ışık çok şaşırtıcı, İstanbul’da günler geçiyor; “evet” dedi."


@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1254", "mac_roman", "cp850"])
def test_round_trip(wrong):
    garbled = "".join(bytes([b]).decode(wrong, errors="ignore") or chr(b) for b in TEXT.encode())
    assert garbled != TEXT
    assert repair(garbled)[0] == TEXT and repair(garbled)[1] > 0 and repair(garbled)[2]


def test_twice_and_partly():
    once = TEXT.encode().decode("latin-1")
    twice = once.encode().decode("latin-1")
    assert repair(twice)[0] == TEXT
    mixed = "Önce doğru yazı. " + once + " Sonra yine doğru."
    assert repair(mixed)[0] == "Önce doğru yazı. " + TEXT + " Sonra yine doğru."


@pytest.mark.parametrize("wrong", ["cp1252", "cp1250"])
def test_turkish_code_page(wrong):
    t = "Gördüğün ışık çok şaşırtıcı, İyi günler"
    assert repair(t.encode("cp1254").decode(wrong, errors="replace"))[0] == t


@pytest.mark.parametrize("text", [
    None, "", "plain", TEXT, "Það er þýðing á íslensku, kökur og mjólk úr sveitinni", "RÜZGÂR VE KÂR İÇİN √ onaylandı “ÂDETA” dedi, 25 °C — naïve café.", "AMANHÃ… É NÃO",
    "“Önce geldi”, “Çok iyi”", "lêcãçõ são", "двигун ve июлька", "Bəli, gözəl",
])
def test_correct_text_stays(text):
    assert repair(text) == (text, 0, True)


def test_lost_characters(spark):
    assert repair("g��l ve Ã§ok") == ("g��l ve çok", 3, False)
    df = spark.createDataFrame([(1, "Ã§ok", "x"), (2, None, "x"), (3, "", "x"), (1, "Ã§ok", "x")], "id int, text string, restored string")
    assert rows(restored(df), "id", "restored", "garbled_spans", "restorable") == [(1, "çok", 1, True), (1, "çok", 1, True), (2, None, 0, True), (3, "", 0, True)]
    assert rows(restored(df, only_affected=True, with_text=False), "id") == [(1,), (1,)]


def test_long():
    n = 20_000
    assert repair("Ã§ok " * n)[:2] == ("çok " * n, n)


@pytest.mark.parametrize("page", ["cp1254", "iso8859_9"])
@pytest.mark.parametrize("wrong", ["cp1251", "cp1253", "mac_roman", "cp437", "cp850", "cp857"])
def test_turkish_page_in_another_script(page, wrong):
    t = "Önce Lohudatmıştı, üç gün vişıfıda peşrilfi; çok güzel öyküler sığdırdı, İyi Şeyler Ağır"
    g = "".join(bytes([b]).decode(wrong, errors="ignore") or chr(b) for b in t.encode(page))
    assert repair(g)[0] == t and repair(g)[1] > 0 and repair(g)[2]
    part = "Doğru yazı bu, рara değişti. " + g + " Şimdi yine doğru, ıрak."
    assert repair(part)[0] == part.replace(g, t)


def test_page_beside_real_words_and_alikes():
    assert repair("цnce ьз двигун gьｎ νьрinin, şimdi двигун рara")[0] == "önce üç двигун güｎ νüğinin, şimdi двигун рara"
    assert repair("ruЂ Уló byhС haЂbe")[1] == 0


@pytest.mark.parametrize("text", ["двигун эра Цена", "Ramu'уа рara ьir", "юзер-friendly ve Эхо", "2πr, πx ve Φ", "a÷b", "■Madde bir ▄ iki", "июлька'da Цнcе", "5²x ve m³te"])
def test_other_scripts_stay(text):
    assert repair(text) == (text, 0, True)


def test_single_letters_by_sentence():
    assert repair("Yorumlarýnýzý aþaðýya yazabilirsiniz.") == ("Yorumlarınızı aşağıya yazabilirsiniz.", 6, True)
    ice = "Það er þýðing á íslensku, kökur og mjólk úr sveitinni. Hann sagði það. "
    assert repair(ice * 5 + "Gördüðün ýþýk çok þaþýrtýcý. " + ice)[0] == ice * 5 + "Gördüğün ışık çok şaşırtıcı. " + ice
    assert repair("Kapý açýk. " + ice)[0] == "Kapı açık. " + ice
    for stays in (ice, "Hann sagði það.", "Þingvellir is a park.", "Među nama, vođa čeka."):
        assert repair(stays) == (stays, 0, True)


def misread(text, encoding, wrong):
    out = []
    for b in text.encode(encoding):
        try:
            out.append(bytes([b]).decode(wrong))
        except UnicodeDecodeError:
            out.append(chr(b))
    return "".join(out)


UTF8_PAIRS = ["cp1252", "latin-1", "cp1254", "mac_roman", "cp850", "cp437", "cp857", "cp1250", "iso8859_2", "cp1251", "cp852", "koi8_r", "cp1256", "iso8859_15"]


@pytest.mark.parametrize("wrong", UTF8_PAIRS)
def test_every_pair_with_utf8(wrong):
    assert repair(misread(TEXT, "utf-8", wrong))[0] == TEXT


@pytest.mark.parametrize("text", ["Merhaba 😀 dünya", "Çok iyi 👍🏽 oldu 🎉", "日本語のテキストです", "שלום עולם", "Привет, мир", "مرحبا بالعالم", "안녕하세요 여러분"])
@pytest.mark.parametrize("wrong", ["cp1252", "latin-1", "cp1254"])
def test_other_scripts_and_emoji(text, wrong):
    assert repair(misread(text, "utf-8", wrong))[0] == text


def test_garbled_any_number_of_times():
    for n in range(1, 7):
        t = TEXT
        for _ in range(n):
            t = misread(t, "utf-8", "latin-1")
        assert repair(t)[0] == TEXT


@pytest.mark.parametrize("page,text", [
    ("cp1251", "Привет мир, как дела сегодня"), ("koi8_r", "Привет мир, как дела сегодня"), ("cp1253", "Καλημέρα κόσμε τι κάνεις σήμερα"),
    ("cp1255", "שלום עולם מה שלומך היום"), ("cp1256", "مرحبا بالعالم كيف حالك"),
])
def test_pages_of_other_alphabets(page, text):
    got = repair("Önce bu. " + misread(text, page, "latin-1") + ". Sonra şu.")
    assert got[0] == "Önce bu. " + text + ". Sonra şu." and got[1] > 0


@pytest.mark.parametrize("text", [
    "café™ naïve «été» à « là »", "──│├── dosya", "3×© 2×”", "m³ ve m²", "Þórður Ólafur", "été à où", "Merhaba 😀 dünya", "日本語のテキスト", "ÖÇÜ ÇÜÖ", "À ÉTÉ ÔÉÈ", "“ç”… ‘é’—", "Çüö çğü ıçü",
])
def test_what_looks_like_garble_stays(text):
    assert repair(text) == (text, 0, True)


def test_never_worse_beside_unknown_bytes():
    """Letters beside bytes that no sequence explains are left alone."""
    t = "Kapý ðŸ açýk ýþýk þaþýrtýcý"
    assert "ðŸ" in repair(t)[0]
