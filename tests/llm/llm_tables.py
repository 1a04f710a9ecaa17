"""Small tables with the awkward rows: nulls, empty and long texts, ties,
repeated rows, hot groups, and extra columns whose names clash."""

from __future__ import annotations

import random

import pandas as pd
import pytest

LANGS = {
    "en": "the and of to in that with for was is th ing er on ea nd re ly sh tion".split(),
    "de": "der die und das mit von für ist im den sch ung en ein keit ü ß lich pf zu".split(),
    "fr": "le la de et les un une pour dans que eau tion oi é ç aux ment elle ê vi".split(),
}
TOXIC = ["moron", "scum", "idiot", "trash", "pathetic"]


def word(rng: random.Random, lang: str) -> str:
    parts = LANGS[lang]
    return rng.choice(parts[:10]) if rng.random() < 0.4 else "".join(rng.choices(parts[10:], k=rng.randint(2, 4)))


def prose(rng: random.Random, lang: str, n: int) -> str:
    out = []
    for k in range(n):
        w = word(rng, lang)
        out.append(w.capitalize() if k % 11 == 0 else w)
        if k % 11 == 10:
            out[-1] += rng.choice([".", ".\n", ","])
    return " ".join(out).replace("\n ", "\n")


def make_tables(seed: int = 5) -> dict[str, pd.DataFrame]:
    rng = random.Random(seed)
    bench = [(k, prose(rng, rng.choice(list(LANGS)), 30)) for k in range(8)]
    bench += [(8, "Four short words here"), (9, ""), (10, None), (11, bench[0][1]), (12, " .,!")]
    docs: list[tuple] = []
    labels = []
    pages = []

    def add(text, lang="en", source=None, doc_id=-1):
        doc_id = len(docs) if doc_id == -1 else doc_id
        docs.append((doc_id, text, lang, source or f"src{rng.randrange(4)}", len(text) if text is not None else None))
        return doc_id

    line = "All rights reserved by the owners of this page."
    for k in range(260):
        lang = rng.choice(list(LANGS))
        text = prose(rng, lang, rng.randint(12, 120))
        kind = k % 13
        toxic, quality = 0, 1
        if kind == 0:
            text += "\n  " + line.upper()
        elif kind == 1:
            b = rng.choice(bench[:8])[1]
            text += " " + " ".join(b.split()[rng.randint(0, 5):rng.randint(17, 30)]) + " " + prose(rng, lang, 10)
        elif kind == 2:
            words = text.split()
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(TOXIC))
            text, toxic = " ".join(words), 1
        elif kind == 3:
            text, quality = " | ".join(text.split()), 0
        elif kind == 4:
            text, quality = " ".join([text.split()[0]] * 40), 0
        elif kind == 5:
            text += " mail a.b9@host-1.example.com or +1 (376) 555-7269, 10.2.3.4, 300.1.1.1 and 4807614710343232."
        elif kind == 6:
            text += " write to jane.doe [at] example [dot] org, or call plus four one five five five five one two three four."
        i = add(text, lang)
        if k % 2 == 0:
            labels.append((i, quality, toxic))
        if k % 3 == 0:
            pages.append((len(pages), f"https://www.{rng.choice(['a', 'b'])}.example.org/{lang}/{i}" + rng.choice(["", "/", "#top", "?page=2", ".html"]),
                          f'<!DOCTYPE html><html lang="{lang}"><head><title>x</title></head><body><p>{text}</p></body></html>'))
    base = docs[7][1]
    for k in range(40):  # a hot group of copies and near copies
        add(base if k % 2 else base + f" {word(rng, 'en')}", docs[7][2], "src0")
    add(None)
    add(None, None, None)
    add("")
    add("   \n\n \t ")
    add("\n".join([line, line, "short", ""]))
    add("word")
    add("a b c")
    add("1234567890 " * 3000 + "x" * 60_000)  # very long
    add(prose(rng, "de", 6000), "de")
    add("Ten words of a line that stays\x0b\x85  one two three")
    add("it's we'll 's <|endoftext|> 😀 中文  \r\n\t x")
    add(docs[3][1], docs[3][2], doc_id=3)  # a repeated row, and one id with two texts
    add(docs[3][1], docs[3][2], doc_id=3)
    add("Another text under the id that is given twice over here", doc_id=4)
    add("A text without an id, lines that nobody else has got", doc_id=None)
    labels += [(0, None, None), (None, 1, 1), (10_000, 1, 0), (2, 1, 0)]
    pages += [(len(pages), None, None), (len(pages) + 1, "not a url", "<p>"), (None, "https://x.de/5", None)]
    d = pd.DataFrame(docs, columns=["doc_id", "text", "lang", "source", "n_chars"])
    d["doc_id"], d["n_chars"] = d["doc_id"].astype("Int64"), d["n_chars"].astype("Int64")
    lab = pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]).astype("Int64")
    pg = pd.DataFrame(pages, columns=["page_id", "url", "html"])
    pg["page_id"] = pg["page_id"].astype("Int64")
    talks = [(c, t, ["user", "assistant"][t % 2], f"turn {t} {c % 3}" if t else "hello") for c in range(30) for t in range(1 + c % 6)]
    talks += [(31, None, None, None), (31, 2, "user", ""), (31, 2, "user", ""), (None, 0, "user", "lost"), (-4, 1, "system", "é" * 5000)]
    ct = pd.DataFrame(talks, columns=["conv_id", "turn", "role", "text"])
    ct["conv_id"], ct["turn"] = ct["conv_id"].astype("Int64"), ct["turn"].astype("Int64")
    return {"conversations": ct, "documents": d, "benchmark": pd.DataFrame(bench, columns=["item_id", "text"]), "labels": lab, "pages": pg}


#: names that the operators use inside or return
CLASHES = ["score", "key", "body", "did", "th", "lines", "drop", "held", "label", "fold", "length", "offset", "language", "host", "declared",
           "component_id", "pos", "n", "line"]

SCHEMAS = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "benchmark": "item_id long, text string",
           "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string", "conversations": "conv_id long, turn long, role string, text string"}


def write_tables(spark, tables, path, clash=True):
    for name, rows in tables.items():
        data = [tuple(None if pd.isna(x) else getattr(x, "item", lambda x=x: x)() for x in r) for r in rows.itertuples(index=False)]
        df = spark.createDataFrame(data, SCHEMAS[name])
        if clash and name == "documents":
            for c in CLASHES:
                df = df.withColumn(c, df["source"])
        df.repartition(3, df.columns[0]).write.parquet(f"{path}/{name}.parquet")
    return path


def ids_and_texts(tables) -> list[tuple[int | None, str | None]]:
    d = tables["documents"]
    return [(None if pd.isna(i) else int(i), None if pd.isna(t) else t) for i, t in zip(d["doc_id"], d["text"])]


@pytest.fixture(scope="session")
def tables():
    return make_tables()


@pytest.fixture(scope="session")
def sf(spark, tables, tmp_path_factory):
    return write_tables(spark, tables, str(tmp_path_factory.mktemp("llm") / "sf"))


@pytest.fixture(scope="session")
def empty_sf(spark, tables, tmp_path_factory):
    return write_tables(spark, {k: v.iloc[:0] for k, v in tables.items()}, str(tmp_path_factory.mktemp("llm") / "none"), clash=False)


@pytest.fixture(scope="session")
def nulls_sf(spark, tables, tmp_path_factory):
    """Every column null in every row."""
    blank = {k: pd.DataFrame([[None] * v.shape[1]] * 3, columns=v.columns) for k, v in tables.items()}
    return write_tables(spark, blank, str(tmp_path_factory.mktemp("llm") / "nulls"), clash=False)
