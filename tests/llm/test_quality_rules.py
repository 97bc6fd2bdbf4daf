import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from yieldcast.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def counts(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = Q.base_counts(rows).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    return {r.doc_id: tuple(r)[1:] for r in got}


def check(spark, texts):
    for i, got in counts(spark, texts).items():
        want = brute(texts[i])
        assert got[:5] == want, (texts[i], got, want)
        assert got[5] == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_base_counts_match_brute_force(spark, rng, words):
    few = words[:4]
    texts = [None, "", " \n\t ", "a", "a b c d e a b c d e", "x\n\nx\n x\ny\n", "  é 漢 \x0b z|<>"]
    texts += [" ".join(rng.choices(few, k=rng.randint(0, 40))) for _ in range(60)]
    texts += ["\n".join(rng.choices(["one line", "two", " two", ""], k=9)) for _ in range(20)]
    texts += [" ".join(rng.choices(words, k=5000)), "same " * 4000]
    check(spark, texts)


@settings(max_examples=8, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n\t|é", max_size=60), min_size=1, max_size=30))
def test_base_counts_of_any_text(spark, texts):
    check(spark, texts)


def corpus(rng, words, n=400):
    """Clean prose of two groups, a hot and a small one, and junk of symbols."""
    rows = []
    for i in range(n):
        source = "hot" if i % 3 else f"s{i % 2}"
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(30, 300))), "en", source, 0))
    for i in range(n, n + 12):
        rows.append((i, " ".join(w + "###" for w in rng.choices(words, k=60)), "en", "hot", 0))
    return rows


def test_outliers_go_and_clean_texts_stay(spark, rng, words, doc_schema):
    rows = corpus(rng, words)
    rows += [(9000, None, None, None, None), (9001, "few words", None, "x", 1), (9002, " ".join(words), None, None, 2)]
    got = {r.doc_id: r for r in Q.quality_rules(spark.createDataFrame(rows, doc_schema)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in range(400)) and not any(got[i].kept for i in range(400, 412))
    assert not got[9000].kept and got[9000].base_failed and not got[9001].kept and got[9002].kept


def test_clashing_names_repeated_rows_and_empty_table(spark, rng, words):
    schema = "doc_id long, text string, lang string, source string, kept string, g string, x0 string, m string, salt string"
    rows = [(i, t, l, s, "k", "g", "x", "m", "s") for i, t, l, s, _ in corpus(rng, words, 100)] * 2
    df = spark.createDataFrame(rows, schema)
    got = Q.quality_rules(df).collect()
    assert len(got) == len(rows) and {r.g for r in got} == {"g"} and {type(r.kept) for r in got} == {bool}
    kept = Q.keep_good(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert Q.quality_rules(df.limit(0)).count() == 0 and Q.keep_good(df.limit(0)).count() == 0


def test_plan_runs_no_python(spark, rng, words, doc_schema):
    df = Q.quality_rules(spark.createDataFrame(corpus(rng, words, 30), doc_schema))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
