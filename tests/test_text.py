import random
import re
import textwrap
import time
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.functions import chunking, frontmatter, ids, sections
from changeflow.functions import text as tx

texts = st.text(
    alphabet=st.one_of(st.sampled_from('\\"ntr \n\t\r:-#`as\x1e éÉ'), st.characters(codec="utf-8", exclude_characters="\x00")),
    max_size=40,
)


@settings(max_examples=5, deadline=None)
@given(st.lists(texts, min_size=30, max_size=60))
def test_unquote_undoes_quote(values, cases):
    assert values(cases, lambda c: tx.unquote(tx.quote(F.col(c)))) == cases


def test_unquote_is_one_pass(values):
    b = "\\"
    cases = {
        f'"C:{b}{b}tmp"': f"C:{b}tmp",
        f'"a{b}nb"': "a\nb",
        f'"q{b}"q{b}""': 'q"q"',
        f'"t{b}there"': "t\there",
        f'"{b}x{b}{b}{b}n"': f"{b}x{b}\n",
        f'"odd{b}"': f"odd{b}",
        '"': '"',
        "  plain ": "plain",
        '　"x" ': "x",
        '"a" b': '"a" b',
    }
    assert values(list(cases), lambda c: tx.unquote(F.col(c))) == list(cases.values())


def test_strip_is_unicode(values):
    cases = [" \x1f a b \x85　", "\t\x0b", "", "x"]
    assert values(cases, lambda c: tx.strip(F.col(c))) == [c.strip() for c in cases]


def test_heading_names(values):
    cases = {
        "Sintoma": "sintoma",
        "SINTOMAS": "sintoma",
        " Evidências ": "evidencia",
        "Evidência": "evidencia",
        "Causas  Prováveis": "causa provavei",
        "Próximos Passos": "proximo passo",
        "s": "",
        "ﬁm": "fim",
        "𝐂𝐚𝐮𝐬𝐚 Ⅷ": "causa viii",
        "ﷺ": unicodedata.normalize("NFKD", "ﷺ"),
        "한국": unicodedata.normalize("NFKD", "한국"),
        "": "",
    }
    assert values(list(cases), lambda c: tx.heading_name(F.col(c))) == list(cases.values())


def document(values, texts):
    return values(texts, lambda c: frontmatter.parse_document(c))


def test_front_matter_fields(values):
    doc = textwrap.dedent(
        '''\
        ---
        schema: 1
        dedup_key: "548d"
        group_key: "{}/{}/{triage=\\"true\\"}:{}"
        alertnames:
          - "PolicyDrop"
          - a: b
        stray
          - "still: open"
        fired_at: "2026-07-05T23:35:20Z"
          - "belongs to nothing"
        none: []
          - "nor this"
        dedup_key: second
        ---

        Preamble.

        ---

          ## First heading
        text
        '''
    )
    (got,) = document(values, [doc])
    entries = {e["key"]: (e["is_list"], e["vals"]) for e in got["fm"]}
    assert entries == {
        "schema": (False, ["1"]),
        "dedup_key": (False, ["second"]),
        "group_key": (False, ['{}/{}/{triage="true"}:{}']),
        "alertnames": (True, ["PolicyDrop", "a: b", "still: open"]),
        "fired_at": (False, ["2026-07-05T23:35:20Z"]),
        "none": (True, []),
    }
    assert got["body"] == "## First heading\ntext"


def test_front_matter_edges(values):
    cases = {
        "## Only body\nx": ([], "## Only body\nx"),
        "no heading\nat all ": ([], "no heading\nat all"),
        "": ([], ""),
        "---": ([], ""),
        "---\n---": ([], ""),
        "---\n---\n# b": ([], "# b"),
        "---\n---\nx: 1\n---\n# b": ([], "# b"),
        " --- \r\na: 1\r\n ---\r\n# b\r\nc": (["a"], "# b\nc"),
        "---\na: 1\nnever closed\n## h": (["a"], ""),
        "---x\na: 1\n---\n# b": ([], "# b"),
        "\n---\na: 1\n---\n# b": ([], "# b"),
        "---\n- orphan\n:empty key\n---\nb": ([""], "b"),
        "---\na: 1 b: 2\x0cc: 3\n---\n# b\x0bx": (["a", "b", "c"], "# b\nx"),
        "---\na: ---\n----\n---\nx #\n\t# y": (["a"], "# y"),
    }
    got = document(values, list(cases))
    assert [([e["key"] for e in g["fm"]], g["body"]) for g in got] == list(cases.values())


def test_last_entry_of_a_key_wins(values):
    doc = "---\nb: 1\na: x\nb:\n  - y\na: z\n---\n"
    (got,) = values([doc], lambda c: frontmatter.last_wins(frontmatter.parse_document(c)["fm"]))
    assert [(e["key"], e["vals"]) for e in got] == [("a", ["z"]), ("b", ["y"])]


def split(values, bodies):
    return [
        {s["section"]: s["text"] for s in row} for row in values(bodies, lambda c: sections.sections(c))
    ]


BODY = """# Triagem: Alvo — `svc-a`

## Sintoma
Pod caiu.

## Evidência
Logs.

### Métricas
subiu para 0.8/s.

## Causa provável
Disco cheio.

## Próximo passo
Limpar.

## Confiança
Alta. Três sinais."""


def test_sections(values):
    fence = "```"
    nested = f"## Sintoma\n{fence}\n# um\n## dois\n### tres\n{fence}\n\n## Causa provável\nreal"
    longer = "## Sintoma\n````\n```\n## dentro\n````\n## Causa provavel\nc"
    info = f"## Sintoma\n{fence}sh\n## a\n{fence} x\n## b\n{fence}\n## Evidencia\ne"
    unclosed = "## Sintoma\ns\n~~~\n## Evidência\ne"
    tilde = f"## Sintoma\n~~~\n{fence}\n## x\n~~~\n## Evidência\ne"
    got = split(
        values,
        [
            BODY,
            "## SINTOMAS\ns\n\n## Evidencia\ne\n\n## Causa Provável\nc\n\n## Próximos Passos\nn",
            "## Outra coisa\ntexto\n\n## Mais uma\nmais",
            nested,
            longer,
            info,
            unclosed,
            tilde,
            "## Sintoma\none\n## Sintoma\ntwo\n## Sintoma\n\n## Evidencia\n",
            "   # Sintoma  \nindented\n    ## Evidencia\nfour spaces\n##Causa provavel\nno space",
            "## Sintoma\na\n##  \nb",
            "no heading",
        ],
    )
    assert set(got[0]) == {"symptom", "evidence", "cause", "next_step"}
    assert got[0]["evidence"].endswith("### Métricas\nsubiu para 0.8/s.")
    assert all("Três sinais" not in v for v in got[0].values())
    assert got[1] == {"symptom": "s", "evidence": "e", "cause": "c", "next_step": "n"}
    assert got[2] == {}
    assert got[3] == {"symptom": f"{fence}\n# um\n## dois\n### tres\n{fence}", "cause": "real"}
    assert got[4] == {"symptom": "````\n```\n## dentro\n````", "cause": "c"}
    assert set(got[5]) == {"symptom", "evidence"} and "## b" in got[5]["symptom"]
    assert set(got[6]) == {"symptom"} and got[6]["symptom"].endswith("## Evidência\ne")
    assert set(got[7]) == {"symptom", "evidence"}
    assert got[8] == {"symptom": "two"}
    assert got[9] == {"symptom": "indented\n    ## Evidencia\nfour spaces\n##Causa provavel\nno space"}
    assert got[10] == {"symptom": "a"}
    assert got[11] == {}


def packed(text, size, overlap, separator):
    """Plain loop over paragraphs: the rule, one sentence at a time."""
    out, current = [], []
    used = lambda: sum(map(len, current)) + 2 * (len(current) - 1)
    for p in filter(None, (x.strip() for x in text.split(separator))):
        if current and used() + 2 + len(p) > size:
            out.append("\n\n".join(current))
            current = []
        if len(p) > size:
            out += [p[o : o + size] for o in range(0, len(p), size - overlap)]
        else:
            current.append(p)
    return out + (["\n\n".join(current)] if current else [])


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.lists(st.text(alphabet="ab é😀\t", max_size=45), max_size=8).map("\n".join), min_size=20, max_size=40
    ),
    st.sampled_from([(20, 5), (12, 0), (30, 29)]),
)
def test_chunks_follow_the_rule(values, texts, shape):
    size, overlap = shape
    got = values(texts, lambda c: chunking.chunks(c, size, overlap, "\n"))
    assert got == [packed(t, size, overlap, "\n") for t in texts]


def test_chunk_defaults(values):
    text = "a" * 998 + "\n\n" + "b" * 5 + "\n\n" + "c" * 2600 + "\n\n" + "d" + "\n\n \n\n" + "e"
    (got,) = values([text], lambda c: chunking.chunks(c))
    assert [len(x) for x in got] == [998, 5, 1000, 1000, 900, 50, 4]
    assert got[-1] == "d\n\ne"


def test_uuid5(values):
    import uuid

    names = ["", "a", "548d681d#evidence", "docs/á.md#12", "x" * 500]
    assert values(names, lambda c: ids.uuid5(F.col(c))) == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in names]
    got = values(["k"], lambda c: F.array(ids.point_id(F.col(c), F.lit("")), ids.point_id(F.col(c), F.lit("cause"))))
    assert got[0] == [str(uuid.uuid5(uuid.NAMESPACE_URL, n)) for n in ("k", "k#cause")]


def test_chunks_of_texts_with_the_marks_between_paragraphs(values):
    texts = [f"a{m}b\n{m * 2}\nccc{m}\n{'d' * 30}{m}\n\ne" for m in chunking.MARKS]
    assert values(texts, lambda c: chunking.chunks(c, 12, 3, "\n")) == [packed(t, 12, 3, "\n") for t in texts]


def test_chunks_of_a_hundred_thousand_paragraphs(values):
    text = "\n\n".join("p" * (i % 7 + 1) if i % 1000 else "long" * 600 for i in range(100_000))
    (got,) = values([text], lambda c: chunking.chunks(c))
    assert got == packed(text, 1000, 150, "\n\n")


def line_by_line(body):
    """The sections again, with the fence carried from line to line."""
    fence, name, found, text = "", None, {}, []

    def close():
        whole = "\n".join(text).strip()
        if name and whole:
            found[name] = whole

    for line in body.split("\n"):
        mark = re.match(r" {0,3}(`{3,}|~{3,})(.*)$", line)
        head = re.match(r"\s{0,3}#{1,2}\s+(.+?)\s*$", line)
        if fence:
            if mark and mark[1].startswith(fence) and not mark[2].strip():
                fence = ""
        elif mark and not (mark[1][0] == "`" and "`" in mark[2]):
            fence = mark[1]
        elif head:
            close()
            name, text = {"Sintoma": "symptom", "Causa provável": "cause"}.get(head[1]), []
            continue
        text.append(line)
    close()
    return found


def test_sections_as_line_by_line(values):
    lines = [
        "```", "````", "```sh", "``` a`b", "~~~", "~~~~", "~~~ x~y", "   ```", "    ```", "```  ", "``", " ~~~\t",
        "## Sintoma", "# Causa provável", "## Outra", "##", "## ", "x", "", "  ", "### y",
    ]
    rng = random.Random(7)
    bodies = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    assert split(values, bodies) == [line_by_line(b) for b in bodies]
    assert sum(map(bool, map(line_by_line, bodies))) > 500


def test_sections_take_time_in_proportion_to_headings(values):
    def seconds(n):
        body = "".join(f"## Causa {i}\nx\n```\n# y\n```\n" for i in range(n)) + "## Sintoma\nok"
        start = time.monotonic()
        assert split(values, [body]) == [{"symptom": "ok"}]
        return time.monotonic() - start

    seconds(10)
    assert seconds(100_000) < 60  # an array grown by one heading at a time takes many minutes
    assert split(values, ["## Sintoma\n```\n" + "x\n" * 1_000_000])[0]["symptom"].count("x") == 1_000_000


def test_accents_are_looked_up(values):
    """Before, a class of thousands of characters was tried one by one at every character of a heading."""
    assert str(tx.without_accents(F.col("text"))).count(r"\x{") <= 2
    chars = [*tx._ONE, *tx._SEVERAL, "\uac00", "\ud7a3", "Causa prov\u00e1vel", "e\u0301", "\ufb01 \u00e9", "\u4e2d \u00e9"]
    texts = [f"a{c}b" for c in chars]
    plain = ["".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x)) for t in texts]
    assert values(texts, lambda c: tx.without_accents(F.col(c))) == plain


def test_line_breaks_of_every_kind(values):
    texts = ["", "a\nb", "a\r\nb\rc", "\r\r\n\n", None, *(f"é{b}x\r\n{b}{b}" for b in tx.RARE_BREAKS)]
    plain = [t and re.sub(f"\r\n|[{tx.RARE_BREAKS}]", "\n", t) for t in texts]
    assert values(texts, lambda c: tx.plain_breaks(F.col(c))) == plain
    assert values(texts, lambda c: tx.normalise_newlines(F.col(c))) == [t and re.sub("\r\n?", "\n", t) for t in texts]
