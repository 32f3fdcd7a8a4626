"""Language model, toxicity grammar, surrogates and the pipeline."""

import json
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contraluz.llm import language_crf, queries, surrogates, toxicity_grammar
from tests.llm.helpers import CLASHING, ODD_ROWS, ODD_TEXTS, frame, prose

TINY, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def by_words(emission, sizes, transition):
    """Forward-backward one word after the other."""
    out, at, move = np.zeros(emission.shape), 0, np.exp(transition)
    for n in sizes:
        e, state, ahead = np.exp(emission[at:at + n].astype(float)), None, []
        state = np.full(emission.shape[1], 1 / emission.shape[1])
        for t in range(n):
            state = (state @ move) * e[t]
            state /= state.sum()
            ahead.append(state)
        back = np.ones(emission.shape[1])
        for t in range(n - 1, -1, -1):
            both = ahead[t] * back
            out[at + t] = both / both.sum()
            back = move @ (e[t] * back)
            back /= back.sum()
        at += n
    return out


def test_blocks_give_the_recursion_word_by_word():
    rng = np.random.default_rng(1)
    sizes = np.array([3, 0, 300, 128, 129, 1, 0, 513])
    emission = (rng.normal(size=(sizes.sum(), 3)) * 3).astype(np.float32)
    transition = rng.normal(size=(3, 3))
    found = language_crf.chain(emission, sizes, transition)[0]
    assert np.allclose(found, by_words(emission, sizes, transition), atol=1e-6)


def test_held_out_languages(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = [r for r in queries.op8_language_crf(spark, SMALL).collect() if r["held_out"]]
    assert len(rows) > 200 and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.98


def test_languages_of_mixed_and_odd_texts(spark):
    rng = random.Random(2)
    lexicons = {"xx": ["foo", "bar", "quux", "zork"], "yy": ["ñandú", "über", "dröm", "ça"]}
    rows = [(i, " ".join(rng.choice(lexicons[lang]) for _ in range(40)), lang)
            for i in range(60) for lang in lexicons] + [(900, None, "xx"), (901, "foo", None)]
    model = language_crf.train(frame(spark, rows, "doc_id long, text string, lang string"), "doc_id")
    assert model.languages == ["xx", "yy"]
    odd = [*ODD_TEXTS, "foo bar " * 20 + "über dröm ça " * 5]
    df = frame(spark, list(enumerate(odd)), lang_pred="mine", **CLASHING)
    got = {r["doc_id"]: r for r in language_crf.predict(df, "text", model).collect()}
    for i in (0, 1, 2, 3):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["shares"]) == ("und", 0.0, {})
    mixed = got[len(odd) - 1]
    assert mixed["lang_pred"] == "xx" and mixed["shares"]["yy"] == pytest.approx(15 / 55)
    assert {got[i]["lang_pred"] for i in (6, 8, 11)} <= {"xx", "yy"}
    nobody = language_crf.train(frame(spark, [], "doc_id long, text string, lang string"))
    assert nobody.languages == []
    assert {r["lang_pred"] for r in language_crf.predict(df, "text", nobody).collect()} == {"und"}
    assert language_crf.predict(df.where("doc_id > 99"), "text", model).count() == 0


def test_predictions_ignore_other_columns(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    model = language_crf.train(docs)
    a = {r["doc_id"]: r["score"] for r in language_crf.predict(docs, "text", model).collect()}
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("none")})
    assert a == {r["doc_id"]: r["score"] for r in language_crf.predict(other, "text", model).collect()}


def readings(text, words=("idiot",), stems=("achlich",)):
    found = toxicity_grammar.Matcher(list(words), list(stems)).readings(text.lower())
    return {k: v for k, v in zip(toxicity_grammar.READINGS, found) if v}


def test_clauses_are_read_in_context():
    assert readings("You are an idiot.") == {"aimed": 1, "clause": 1}
    assert readings("Idiot that you are!") == {"bare": 1, "followed": 1, "clause": 1}
    assert readings("He is not an idiot. Idiot") == {"negated": 1, "bare": 1, "clause": 1}
    assert readings("not all of them over there, idiot") == {"bare": 1, "clause": 1}
    assert readings('She said he is an idiot; "idiot" was the word') == {"reported": 2}
    assert readings("I will kill you, you know") == {"violence": 1, "followed": 1, "clause": 1}
    assert readings("you die, they kill") == {"violence": 1, "clause": 1}
    assert readings("achlich achlichbe idiotic") == {"bare": 1, "clause": 1}
    assert readings("") == {} and readings("nothing here") == {}


def test_composition_is_one_table():
    moves, writes = toxicity_grammar.grammar()
    assert 20 < len(moves) < 200
    assert all(set(m) == set(toxicity_grammar.SYMBOLS) for m in moves)


def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.1"
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [(r["predicted"], marks[r["doc_id"]], r["score"]) for r in
            queries.op3_toxicity_grammar(spark, sf).collect()
            if r["held_out"] and r["doc_id"] in marks]
    hits = sum(p and t for p, t, _ in rows)
    assert hits / sum(t for _, t, _ in rows) > 0.85
    assert hits / max(1, sum(p for p, _, _ in rows)) > 0.9
    assert all(0 <= s <= 1 and p == (s >= 0.5) for p, _, s in rows)


def test_toxicity_of_odd_rows(spark):
    docs = frame(spark, ODD_ROWS, **CLASHING)
    labels = frame(spark, [(i, i % 2) for i in range(12)] + [(4, 1), (None, 1), (77, 1), (3, None)],
                   "doc_id long, toxic int")
    model = toxicity_grammar.train(docs, labels)
    rows = toxicity_grammar.score(docs, "text", model).collect()
    assert len(rows) == len(ODD_ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    alone = toxicity_grammar.train(docs, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity_grammar.score(docs, "text", alone).collect()} == {0.0}
    empty = toxicity_grammar.train(frame(spark, []), labels)
    assert toxicity_grammar.score(docs.where("doc_id > 99"), "text", empty).count() == 0


PERSONAL = [
    "Write to Ann.Lee+x@Mail.example.org or ann.lee+x@mail.EXAMPLE.org.",
    "Call +1 (212) 555-0123, +1 212 555 0123 or (212) 555-0123 from 10.20.30.255",
    "Mr. John Smith met Mrs Jane Doe; Herr Müller, HERR MÜLLER and Frau Иванова",
    "4111 1111 1111 1111 / 4111111111111111 / 1234567890123456, DE89 3704 0044 0532 0130 00",
    'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" sk-abcdefghijklmnop1234 078-05-1120',
    "Version 2.0 of 1999, 12.5 and 1.2.3, no person", None, "", "é",
]


def test_surrogates_keep_form_and_identity(spark):
    df = frame(spark, list(enumerate(PERSONAL)) + [(0, PERSONAL[0])], **CLASHING)
    rows = {r["doc_id"]: r for r in surrogates.replace(df, "key").collect()}
    text = {i: r["text"] for i, r in rows.items()}
    assert [text[i] for i in (5, 6, 7, 8)] == PERSONAL[5:9]
    assert rows[6]["entities"] is None and rows[7]["entities"] == [] and rows[0]["score"] == "mine"
    a, b = (e["surrogate"] for e in rows[0]["entities"])
    assert a != b and a.lower() == b.lower() and a.endswith(".org") and "@" in a
    first, second, third, ip = (e["surrogate"] for e in rows[1]["entities"])
    assert re.sub(r"\d", "9", first) == "+9 (999) 999-9999" and first.startswith("+1 ")
    assert re.sub(r"\D", "", first) == re.sub(r"\D", "", second)
    assert all(0 <= int(x) < 256 for x in ip.split(".")) and third != PERSONAL[1]
    john, jane, herr, loud, frau = (e["surrogate"] for e in rows[2]["entities"])
    assert john.split()[1] in surrogates.MALE_NAMES.split()
    assert jane.split()[1] in surrogates.FEMALE_NAMES.split()
    assert herr.startswith("Herr ") and loud == herr.upper()
    assert re.fullmatch(r"Frau [А-Я][а-я]+", frau)
    spaced, plain, other, iban = (e["surrogate"] for e in rows[3]["entities"])
    assert spaced.replace(" ", "") == plain and plain[0] == "4" and len(other) == 16
    digits = [int(c) for c in plain[::-1]]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", iban)
    assert [e["kind"] for e in rows[4]["entities"]] == ["secret", "secret", "ssn"]
    assert re.fullmatch("[0-9a-f]{40}", rows[4]["entities"][0]["surrogate"])
    again = {r["doc_id"]: r["text"] for r in surrogates.replace(df, "key").collect()}
    other = {r["doc_id"]: r["text"] for r in surrogates.replace(df, "other key").collect()}
    assert again == text and other[0] != text[0]


def test_entities_of_many_forms_are_found(spark):
    forms = ["jane.doe@example.com", "jane@x.org", "06 12 34 56 78", "06.12.34.56.78", "030 1234567",
             "0301234567", "5551234567", "555 123 4567", "2001:db8:0:0:1:0:0:1", "fe80::1", "::1",
             "2001:db8::", "sk-abcdefghijklmnopqrst", "Prof. Weber", "г-н Иванов", "госпожа Петрова",
             "Κύριος Παππάς", "+442071234567", "+44 20 7123 4567", "+49 30 1234567"]
    rows = [(2 * i + k, f if k else f"see {f}, so") for i, f in enumerate(forms)
            for k in (0, 1)]
    rows += [(100, "_jane.doe@example.com_"), (101, "-jane@x.org"), (102, "...jane@x.org"),
             (103, "a@b.org_jane@x.org")]
    keep = ["01.02.2024 12:30", "at 1699999999", "12:30:45", "std::dead a::b", "0.123456789",
            "of 2024 and 1,234,567,890", "PostScript"]
    rows += [(200 + i, t) for i, t in enumerate(keep)]
    made = {r["doc_id"]: r for r in surrogates.replace(frame(spark, rows), "key").collect()}
    for i, f in enumerate(forms):
        for k in (0, 1):
            assert f not in made[2 * i + k]["text"] and len(made[2 * i + k]["entities"]) == 1, f
    for i in (100, 101, 102, 103):
        assert "jane" not in made[i]["text"]
    assert made[103]["text"].endswith(made[3]["text"])
    assert [made[200 + i]["text"] for i in range(len(keep))] == keep
    compact, spaced = (made[2 * forms.index(f) + 1]["text"] for f in forms[-3:-1])
    assert compact == spaced.replace(" ", "") and compact.startswith("+44")
    assert re.fullmatch("Κύριος [Α-Ω][α-ω]+", made[2 * forms.index("Κύριος Παππάς") + 1]["text"])


def test_colliding_surrogates_are_drawn_again(spark):
    # two-digit octets of one short form: more entities than a first drawing keeps apart
    people = [f"Mr Ab{a}{b}" for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    mails = [f"{a}{b}@{c}.de" for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    rows = [(i, " , ".join(chunk)) for i, chunk in enumerate(
        [people[k:k + 16] for k in range(0, 256, 16)] + [mails[k:k + 24] for k in range(0, 216, 24)])]
    df = frame(spark, rows)
    entities = surrogates.stored(surrogates.distinct_entities(df, "text"))
    assert entities.count() == 256 + 216
    assert surrogates.redrawn(entities, "k").count() > 0
    got, source = defaultdict(set), {}
    for r in surrogates.replace(df, "k").collect():
        for old, e in zip(dict(rows)[r["doc_id"]].split(" , "), r["entities"]):
            got[e["surrogate"].lower()].add(old)
            source[old] = e["surrogate"]
        assert r["text"] == " , ".join(source[x] for x in dict(rows)[r["doc_id"]].split(" , "))
    assert all(len(v) == 1 for v in got.values())
    assert not set(got) & {x.lower() for x in people + mails}


def test_surrogate_query_leaves_nothing_and_runs_no_python(spark):
    df = queries.op5_surrogates(spark, SMALL)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval|MapIn", plan)
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    secret = re.compile(r"[\w.+-]+@mail\d\.example\.com|\b[0-9a-f]{40}\b|\b\d{16}\b|\+1 \(\d{3}\) 555-\d{4}")
    found = 0
    for r in df.collect():
        for old in secret.findall(before[r["doc_id"]]):
            found += 1
            assert old not in r["text"]
        assert r["n_replaced"] == len(json.loads(r["replaced"]))
    assert found > 50


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rows = corpus_pipeline.run(spark, TINY)
    assert [c for c in rows.columns if c in docs.columns] == docs.columns
    assert rows.count() == rows.select("doc_id").distinct().count() > 100
    assert rows.where("size(token_ids) <> n_tokens OR n_chars <> length(text)").count() == 0


def test_near_dedup_goes_by_the_text(spark):
    a, b, c = prose(1, 120), prose(2, 120), prose(3, 120)
    near = lambda t, w: t + " " + w
    rows = [(7, a), (7, b), (7, near(a, "zz")), (7, None), (7, None), (9, near(b, "more")),
            (None, near(b, "less")), (None, c), (None, c), (7, a), (5, "one"), (6, " "), (None, " ")]
    rows += [(40, prose(100 + i, 90)) for i in range(12)]  # unlike texts of one id
    left = corpus_pipeline.near_dedup(spark, frame(spark, rows), TINY).collect()
    expected = [(7, a), (7, b), (7, None), (None, c), (5, "one"), (6, " "), (None, " ")] + rows[-12:]
    assert len(left) == len(expected) and {tuple(r) for r in left} == set(expected)


def test_stages_on_odd_rows(spark):
    ddl = "doc_id long, text string, lang string, source string, n_chars long"
    leak = spark.read.parquet(f"{TINY}/benchmark.parquet").first()["text"]
    rows = [(i, t, "en" if i != 3 else None, "s", len(t or "")) for i, t in ODD_ROWS]
    rows += [(70 + i, prose(70 + i, 90), "de", "s", 0) for i in range(9)]
    rows += [(90, prose(5, 50) + " " + leak, "de", "s", 0), (91, "mail a.b@c.org", "de", "s", 0)]
    # the last two stand for columns that only some tables have
    docs = frame(spark, rows, ddl, score="mine", entities="e")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs_after = surrogates.stored(stage(spark, docs, TINY))
        if name != "encode_tokens":
            assert docs_after.columns == docs.columns
        out[name], docs = docs_after, docs_after
    ids = {n: sorted(r["doc_id"] for r in d.where("doc_id IS NOT NULL").collect())
           for n, d in out.items()}
    assert not {0, 1, 2, 3} & set(ids["language_id"])
    assert ids["near_dedup"].count(4) == 1 and ids["near_dedup"].count(5) == 1
    assert 90 in ids["near_dedup"] and 90 not in ids["decontaminate"]
    assert set(range(70, 79)) <= set(ids["encode_tokens"])
    assert "a.b@c.org" not in out["private_data"].where("doc_id = 91").first()["text"]
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, frame(spark, [], ddl), TINY).count() == 0


def test_hosts_of_any_length_do_no_harm(spark):
    host = ".".join(f"part{i}" for i in range(100))
    texts = [f"a@{host}.com x", "a@" + "b." * 3000 + "com", "x " + "a@" + "bb." * 400_000 + "com y",
             "a@" + "b-" * 50_000, "@" * 100_000, "a." * 100_000 + "@b.org", "a@b.org."]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in surrogates.replace(df, "key").collect()}
    kinds = {i: [e["kind"] for e in found[i]["entities"]] for i in found}
    assert kinds == {0: ["email"], 1: [], 2: ["email"], 3: [], 4: [], 5: ["email"], 6: ["email"]}
    # a name has at most 127 labels: what is longer is none, or its first 128 labels are taken
    assert all(found[i]["text"] == texts[i] for i in (1, 3, 4))
    assert "a@bb." not in found[2]["text"] and len(found[2]["text"]) == len(texts[2])
    assert host not in found[0]["text"] and found[6]["text"].endswith(".org.")
