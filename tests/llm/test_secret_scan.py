import hashlib
import re

from platewise.llm import secret_scan as M

TEXTS = ["password=abcdef1 and Secret : 'x' then secret=token:abcdefgh", 'API_KEY": "zzzzzz" apikey=abc.def-ghi api-key=abcdef',
         "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " xAKIAAKIA" + "9" * 12, "deadbeef" * 3 + " " + "0" * 23 + " g" + "f" * 24,
         "token = \"" + "0123456789abcdef" * 2 + "\"", "ſecret=abcdefg toKen=abcdefg", "", None,
         "漢字🙂 passwd=hunter22 🙂 " + "a" * 30, "token=" + "k9" * 50_000]


def brute(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def line(spans):
    return ",".join(f"{M.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_the_patterns(spark, docs):
    rows = [(i, t) for i, t in enumerate(TEXTS + TEXTS)] + [(None, TEXTS[0])] + [(r.doc_id, r.text) for r in docs.collect()]
    got = M.scan_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        b = brute(t)
        want.append((i, *[sum(k == n for _, k, _ in b) for n in range(3)], hashlib.sha256(line(b).encode()).hexdigest()))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    for r in got:  # added spans never replace base ones
        base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("novel"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_novel_strings_in_sensitive_context():
    s = M.Scanner()
    kinds = lambda t: [(M.KINDS[k], t[a:b]) for a, k, b, _ in s.scan(t)]
    assert kinds("my private key is Zx8#kQ2pLw9vRt5yBn3m ok") == [("novel", "Zx8#kQ2pLw9vRt5yBn3m")]
    assert kinds("credential q9J4mZ7xK2vT8bN5wR1c") == [("novel", "q9J4mZ7xK2vT8bN5wR1c")]
    assert kinds("the label is Zx8#kQ2pLw9vRt5yBn3m ok") == []  # no sensitive word
    assert kinds("bearer application_settings_version_2") == []  # identifiers
    seen = "q9J4mZ7xK2vT8bN5wR1c"
    assert kinds(f"id {seen} is public; credential {seen} again {seen}") == []  # copied from its surroundings
    assert kinds("the token 2024-01-01T00:00:00 of localhost") == []


def test_candidates_on_both_sides_of_words_within_identifiers():
    s = M.Scanner()
    novel = lambda t: [t[a:b] for a, k, b, _ in s.scan(t) if M.KINDS[k] == "novel"]
    x, letters = "vT8bN5wR1cQ9J4mZ7xK2uYp3hD6gLs0aEiWfXo4T", "GyKwILALovRbrMQSkSuIKKgTPnOKrshe"
    for t in ('secretAccessKey: "{}"', 'secretKey = "{}"', 'tokenValue = "{}"', 'dbpass = "{}"', "tokens {}", "my secrets: {}",
              "USER_CREDENTIALS {}", "{} is the password", "credential " + "of the user " * 6 + "{}"):
        assert novel(t.format(x)) == [x], t
    assert novel('dbPassword = "#Zx8kQ2pLw9vRt5yBn3m"') == ["#Zx8kQ2pLw9vRt5yBn3m"]
    assert novel(f"credential {letters}") == [letters] and novel("credential 7715#1620#4661-99067") != []  # letters only, none
    assert novel("signature=" + x) == [x] and novel("see kQ2pLw9vpwdRt5yBn3mZ8") == ["kQ2pLw9vpwdRt5yBn3mZ8"]
    assert novel("PRODUCTION_DATABASE_PASSWORD = getCredentialsForAuthenticatedUser(request)") == []  # the word's own names
    assert novel("credential " + "x, " * 30 + x) == novel(x + " x," * 30 + " credential") == []  # out of reach
    assert novel(f"a passenger {x} of the compassion") == [] and novel("the token " + "-" * 40) == []
    long = "token_" * 20_000 + x
    assert [len(t) for t in novel(long)] and len(s.scan("token=k#" * 20_000)) < 20_000


def test_a_secret_that_goes_beyond_a_base_span_is_masked_whole(spark):
    secrets = ["Zx8kQ2p#Lw9vRt5yBn3mQq", "q9J4mZ7xK2vT8bN5wR1c~y3H!d6Gs", "ab" * 13 + "!Lw9vRt5yBn3mQq7Kz2Xp8"]
    texts = [f"{a}{x}{b} end" for x in secrets for a, b in (("password: ", ""), ("password=", ""), ("dbSecret = \"", "\""), ("the token ", ""))]
    kinds = [[M.KINDS[k] for _, k, _, _ in M.Scanner().scan(t)] for t in texts]
    assert kinds[0] == ["assign", "novel"] and kinds[-1] == ["hex", "novel"]
    assert [M.KINDS[x[1]] for x in M.Scanner().scan("password: Zx8kQ2pLw9vRt5yBn3mQq")] == ["assign"]  # covered whole
    got = [r.text for r in M.redact(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).orderBy("doc_id").collect()]
    for new, secret in zip(got, [x for x in secrets for _ in range(4)]):
        assert "[SECRET]" in new and new.endswith(" end") and not any(secret[k:k + 4] in new for k in range(len(secret) - 3)), new


def test_novelty_orders_random_before_known():
    s = M.Scanner()
    t = "credential authorization_signature_1 here; credential vT8bN5wR1cQ9J4mZ7xK2uYp3 there"
    a, b = (t.index(x) for x in ("authorization_", "vT8b"))
    assert s.novelty(t, b, b + 24) > M.NOVELTY > s.novelty(t, a, a + 25)


def test_redaction(spark, odd, none):
    rows = [(1, TEXTS[0], 5), (2, "clean", 77), (3, None, None), (4, TEXTS[8], 1), (4, TEXTS[8], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int")
    got = sorted(map(tuple, M.redact(df).collect()), key=str)
    clean = lambda t: M.masked(t, [(a, b) for a, _, b in brute(t)], "[SECRET]")
    want = [(1, clean(TEXTS[0]), len(clean(TEXTS[0]))), (2, "clean", 77), (3, None, None)] + [(4, clean(TEXTS[8]), len(clean(TEXTS[8])))] * 2
    assert got == sorted(want, key=str) and "hunter22" not in got[3][1]
    assert M.masked("abcdef", [(0, 2), (1, 3), (3, 4), (5, 6)], "*") == "**e*"
    assert M.redact(odd).columns == odd.columns and M.redact(none).count() == 0
    assert M.find_secrets(odd).count() == odd.count()
