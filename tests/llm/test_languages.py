import random

import pytest

from quarrylamp.llm import languages

SENTENCES = {
    "en": ["The night shift checked the server and found nothing wrong.", "Every request was stored before the power came back.", "Please send the report to the office by Monday."],
    "fr": ["L'équipe de nuit a contrôlé le serveur sans rien trouver.", "Chaque requête a été enregistrée avant le retour du courant.", "Merci d'envoyer le rapport au bureau avant lundi."],
    "es": ["El turno de noche revisó el servidor y no encontró nada.", "Cada petición fue guardada antes de que volviera la corriente.", "Por favor envíe el informe a la oficina antes del lunes."],
    "de": ["Die Nachtschicht prüfte den Server und fand keinen Fehler.", "Jede Anfrage wurde gespeichert, bevor der Strom zurückkam.", "Bitte senden Sie den Bericht bis Montag an das Büro."],
    "ru": ["Ночная смена проверила сервер и ничего не нашла.", "Каждый запрос сохранили до возвращения питания.", "Пожалуйста, отправьте отчёт в офис до понедельника."],
    "zh": ["夜班检查了服务器，没有发现任何问题。", "每个请求都在恢复供电之前保存完毕。", "请在周一之前把报告发送到办公室。"],
}


@pytest.fixture(scope="module")
def model():
    return languages.fit({k: [" ".join(SENTENCES[k])] * 3 for k in languages.LANGS} | {"en": [" ".join(SENTENCES["en"])] * 3 + [" ".join(SENTENCES["fr"])]})


@pytest.mark.parametrize("lang", languages.LANGS)
def test_single_language(model, lang):
    langs, runs = languages.analyse(" ".join(SENTENCES[lang]), model)
    assert [k for k, _ in langs] == [lang] and langs[0][1] > 0.9 and not runs


def test_passage_of_two_sentences_counts_and_one_does_not(model):
    body = SENTENCES["en"] * 2
    two = " ".join(body[:3] + SENTENCES["de"][:2] + body[3:])
    langs, runs = languages.analyse(two, model)
    assert {k for k, _ in langs} == {"en", "de"} and len(runs) == 1
    s, e, lang, conf = runs[0]
    assert two[s:e].strip() == " ".join(SENTENCES["de"][:2]) and lang == "de" and conf > 0.9
    one = " ".join(body[:3] + SENTENCES["de"][:1] + body[3:])
    assert [k for k, _ in languages.analyse(one, model)[0]] == ["en"]


def test_nothing_told(model):
    assert languages.analyse("12345 / 67-8 QA-12 10.0.0.1", model) == ([], [])


def test_records_with_dirt(spark, make_records, model):
    en, de = " ".join(SENTENCES["en"]), " ".join(SENTENCES["de"])
    rows = [("ok", en, "en-US"), ("ok2", en, " EN"), ("wrong", en, "de"), ("none", de, None), ("und", de, "und"), ("short", "too short", None), ("mix", en + " " + de, "en"),
            ("null", None, "en"), ("blank", "  \n", ""), (None, de, None), ("wrong", en, "de")]
    out = {tuple(r) for r in languages.mislabelled(make_records(rows), model).collect()}
    assert out == {("wrong", "en"), ("none", "de"), ("und", "de"), ("mix", "en"), ("mix", "de")}
    assert languages.mislabelled(make_records(rows).limit(0), model).count() == 0
    told = languages.identify(make_records(rows), model).collect()
    assert {r.id for r in told} == {"ok", "ok2", "wrong", "none", "und", "short", "mix"}


def test_held_out_accuracy(spark):
    """Fitted on one half of generated sentences, asked about the other."""
    rng = random.Random(1)
    def make(k):
        words = " ".join(SENTENCES[k]).replace(".", "").split()
        return " ".join(rng.choice(words) for _ in range(12)) + "."
    m = languages.fit({k: [make(k) for _ in range(30)] for k in languages.LANGS})
    ask = [(k, make(k)) for k in languages.LANGS for _ in range(25)]
    right = sum(languages.analyse(t, m)[0][:1] != [] and languages.analyse(t, m)[0][0][0] == k for k, t in ask)
    assert right / len(ask) >= 0.97


UKRAINIAN = "Нічна зміна перевірила сервер і нічого не знайшла. Кожен запит зберегли до повернення живлення. Будь ласка, надішліть звіт до офісу."
JAPANESE = "夜勤はサーバーを確認し、何も問題を見つけませんでした。すべての要求は電源が戻る前に保存されました。"


def test_other_languages_by_their_letters(model):
    for text in (UKRAINIAN, JAPANESE, "Η νυχτερινή βάρδια έλεγξε τον διακομιστή και δεν βρήκε τίποτα.", "야간 근무조가 서버를 점검했지만 아무 문제도 찾지 못했습니다."):
        langs, runs = languages.analyse(text, model)
        assert [k for k, _ in langs] == [languages.OTHER] and not runs


def test_scripts_are_told_by_their_n_grams(model):
    # an English sentence inside Chinese text, and Latin names, change nothing
    text = "".join(SENTENCES["zh"]) + "请把 server report 发送到 office 办公室。"
    assert [k for k, _ in languages.analyse(text, model)[0]] == ["zh"]
    mixed = "".join(SENTENCES["zh"]) + "\n\n" + " ".join(SENTENCES["ru"][:2])
    assert {k for k, _ in languages.analyse(mixed, model)[0]} == {"zh", "ru"}


def test_sample_is_bounded(spark, make_records, monkeypatch):
    monkeypatch.setattr(languages, "SAMPLE_CHARS", 50)
    seen = {}
    monkeypatch.setattr(languages, "fit", lambda texts: seen.update(texts))
    rows = [(f"{k}{i}", " ".join(SENTENCES[k]), k) for k in languages.LANGS for i in range(9)]
    languages.fit_on(make_records(rows + [("n", None, "en"), ("b", " ", "en"), ("x", "ciao a tutti", "it")]), sample=4)
    assert {k: len(v) for k, v in seen.items()} == dict.fromkeys(languages.LANGS, 4) and all(len(t) <= 50 for v in seen.values() for t in v)
