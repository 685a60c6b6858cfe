"""Share of generated garbling that is found and restored, by chain."""

import random
from collections import Counter

from graphloom.llm import garbled

WORDS = {
    "fr": "santé forêt écoles près déjà élèves été où façade créé mère très réseau région qualité sécheresse".split(),
    "de": "Bäume Flüsse Gewässer über früher größer Straße Höhe Wälder Zahl können Bürger täglich schön".split(),
    "pl": "zdrowie rzeka źródło powietrze żywność łąka jakość wieś część główny wąski międzynarodowy".split(),
    "ru": "вода воздух здоровье леса школа река город климат почва берег сезон данные".split(),
}


def test_found_and_restored_by_chain(spark):
    rng = random.Random(11)
    chains = [("utf-8", "cp1252", "fr"), ("utf-8", "cp1252", "de"), ("utf-8", "latin_1", "fr"), ("utf-8", "cp1251", "ru"), ("cp1251", "cp1252", "ru"), ("koi8_r", "cp1251", "ru"), ("iso8859_2", "cp1252", "pl"), ("cp1252", "mac_roman", "de")]
    rows, truth = [], {}
    for i in range(1600):
        lang = rng.choice(list(WORDS))
        t = clean = " ".join(rng.choice(WORDS[lang]) for _ in range(14)) + "."
        if i % 10 == 0:
            true, read, lang = chains[i // 10 % len(chains)]
            clean = " ".join(rng.choice(WORDS[lang]) for _ in range(14)) + "."
            try:
                t = clean.encode(true).decode(read)
            except UnicodeDecodeError:
                t = clean.encode(true).decode(read, "replace")
            if t != clean:
                truth[i] = (f"{true}>{read}", clean)
        rows.append((i, t, f"s{i % 3}"))
    rows += [(9000, "a broken � mark", "s0"), (9001, "plain", None), (9002, None, "s0"), (9003, "", "s0")]
    got = {r.doc_id: r for r in garbled.diagnose(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert got[9000].chain == garbled.LOSSY and not got[9000].complete and not {9001, 9002, 9003} & set(got)
    found, restored, total = Counter(), Counter(), Counter()
    for i, (c, clean) in truth.items():
        total[c] += 1
        found[c] += i in got
        restored[c] += i in got and (got[i].restored == clean or not got[i].complete)
    wrong = [i for i in got if i not in truth and i < 9000]
    assert sum(found.values()) >= 0.98 * sum(total.values()), (found, total)
    assert sum(restored.values()) >= 0.95 * sum(total.values()), (restored, total)
    assert len(wrong) <= 0.01 * len(rows), wrong[:5]
