"""The lexer: joined literals against their texts, programs made with known secrets, and texts that grow by joining."""

import random
import time

from hypothesis import given
from hypothesis import strategies as st

from marketloom.llm import secrets


def lexed(text):
    return [text[a:b] for kind, a, b, _, _ in secrets.find(text, 0.5) if kind == "lexed"]


@given(st.lists(st.text(alphabet="abEx9<> -_expl", max_size=20) | st.sampled_from(["exam", "ple", "your", "-x", "none", "n", "one", "change", "me"]), min_size=1, max_size=8))
def test_joined_literals_score_as_their_text(parts):
    whole, text = secrets.Literal.of(""), "".join(parts)
    for p in parts:
        whole = whole.then(secrets.Literal.of(p))
    alone = secrets.Literal.of(text)
    assert whole._replace(counts=dict(whole.counts)) == alone._replace(counts=dict(alone.counts))
    assert secrets.literal_score(whole) == secrets.literal_score(text)


def test_values_that_double_with_every_line():
    for line in ("a = a + a\n", 'a = "${a}${a}"\n', "a = a . a . a\n"):
        text = 'a = "xK9-qW7_Lm"\n' + line * 60 + 'a2 = a\ndb_pwd = a + "Zq7-"\n'
        began = time.process_time()
        assert lexed(text) == ["Zq7-"] and time.process_time() - began < 2
        *_, last = secrets.lex(text)
        assert last.value.length > 2**60


def test_common_assignments():
    for text, want in {
        'db_pwd: str = "Zx9-Qw7_Lm3!"': ["Zx9-Qw7_Lm3!"],
        'const dbPwd: string = "Zx9-Qw7_Lm3!";': ["Zx9-Qw7_Lm3!"],
        "client_credential: Optional[str] = 'Zx9-Qw7_Lm3!'": ["Zx9-Qw7_Lm3!"],
        'signing_key = """Zx9-Qw7_Lm3!"""': ["Zx9-Qw7_Lm3!"],
        "signing_key = '''Zx9-Qw7'Lm3!'''": ["Zx9-Qw7'Lm3!"],
        'x' * 300 + '_passphrase = "Zx9-Qw7_Lm3!"': ["Zx9-Qw7_Lm3!"],
        'passphrase = "correcthorsebattery"': ["correcthorsebattery"],
        'credentials = "hunterhunter"': ["hunterhunter"],
        'credentials = "yourexample"': [],
        'credentials = "aaaaaaaaaaaa"': [],
        "credentials = hunterhunter": [],
        'pwd_file = "hunterhunter"': [],
        'passphrase = """unclosed and "then" nothing': [],
        'passphrase: str = other': [],
    }.items():
        assert lexed(text) == want, text
    assert [(x.name, x.value) for x in secrets.lex("a: int = 'q'\nb: x=1\nc=a\n")] == [("a", "q"), ("b", "x=1"), ("x", "1"), ("c", "q")]


def test_made_programs():
    """Lines of every form with secrets and plain values; exactly the secrets are found, in order."""
    rng = random.Random(6)
    for _ in range(200):
        lines, want = [], []
        for i in range(rng.randint(1, 12)):
            value = "".join(rng.choice("abcdefghkmnpqrstuvwxyzABCDEFGHKMNPQRTUVWXYZ23456789-_!") for _ in range(rng.randint(14, 30)))
            if secrets.literal_score(value) < 0.7:
                continue
            hidden = rng.random() < 0.5
            name = f"{rng.choice(['db_pwd', 'signingKey', 'clientCredential', 'AUTH_SIG'])}" if hidden else rng.choice(["title", "colour", "monkey", "path"])
            quote = rng.choice(["'", '"', '"""', "'''"])
            form = rng.randint(0, 5)
            literal = f"{quote}{value}{quote}"
            if form == 0:
                lines.append(f"{name} = {literal}")
            elif form == 1:
                lines.append(f'  "{name}": {literal},')
            elif form == 2:
                lines.append(f"let {name}: string = {literal};")
            elif form == 3:
                lines.append(f"{name} := {literal}")
            elif form == 4:
                lines += [f"k{i} = {literal}", f"{name} = k{i}"]
            else:
                lines += [f"k{i} = {literal}", "x = 1", f'{name} = "${{k{i}}}"']
            want += [value] if hidden else []
        got = lexed("\n".join(lines))
        # A secret by way of a quoted name has the span of the quotes that hold the name.
        assert len(got) == len(want) and all(g == w or g.startswith("${k") for g, w in zip(got, want)), lines
