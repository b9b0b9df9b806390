"""DuckDB SQL of the registered queries that SQL can express; written apart from the operators."""

from __future__ import annotations

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _pii() -> str:
    digits = "regexp_replace({v}, '[^0-9]', '', 'g')"
    luhn = (
        "list_sum(list_transform(range(length(d)), lambda i: CASE WHEN i % 2 = 0 THEN d[length(d) - i]::INT "
        "WHEN d[length(d) - i]::INT > 4 THEN d[length(d) - i]::INT * 2 - 9 ELSE d[length(d) - i]::INT * 2 END)) % 10 = 0"
    )
    turned = "(replace(v, ' ', '')[5:] || replace(v, ' ', '')[1:4])"
    code = "CASE WHEN ascii(c) >= 65 THEN (ascii(c) - 55)::VARCHAR ELSE c END"
    number = f"list_aggregate(list_transform(string_split({turned}, ''), lambda c: {code}), 'string_agg', '')"
    # the remainder piece by piece: seven digits at a time fit with the two before them
    rest = (
        f"list_reduce(list_prepend(0, list_transform(string_split({number}, ''), lambda c: c::INT)), lambda a, c: (a * 10 + c) % 97)"
    )
    kinds = {
        "email": (1, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true", "1.0"),
        "ip": (2, "[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+",
               "list_bool_and(list_transform(string_split(v, '.'), lambda x: x::HUGEINT <= 255))", "1.0"),
        "card": (3, "[0-9](?:[ -]?[0-9])+", f"length(d) BETWEEN 13 AND 19 AND {luhn}", "1.0"),
        "phone": (4, "\\+[0-9][ ().0-9-]+[0-9]", "length(d) BETWEEN 9 AND 15", "1.0"),
        "iban": (5, "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
                 f"length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND {rest} = 1", "0.7"),
        "ssn": (6, "[0-9]{3}-[0-9]{2}-[0-9]{4}",
                "v[1:3] NOT IN ('000', '666') AND v[1:1] <> '9' AND v[5:6] <> '00' AND v[8:] <> '0000'",
                "CASE WHEN regexp_matches(near, '(^|[^a-z])(?:ssn|social security|tax id|taxpayer)([^a-z]|$)') THEN 0.8 ELSE 0.4 END"),
    }
    parts = []
    for kind, (place, pattern, valid, score) in kinds.items():
        parts.append(f"""
            SELECT doc_id, '{kind}' AS kind, {place} AS place, s, e FROM (
              SELECT *, {digits.format(v="v")} AS d,
                translate(substr(text, greatest(s - 40, 0) + 1, least(40, s)), '{_UP}', '{_LOW}') AS near
              FROM (
                SELECT doc_id, text, m[i] AS v, coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)::INT AS s,
                  s + length(m[i]) AS e
                FROM (
                  SELECT doc_id, text, m, unnest(range(2, len(m) + 1, 2)) AS i FROM (
                    SELECT doc_id, text, string_split(regexp_replace(translate(text, chr(1), chr(3)), '({pattern})', chr(1) || '\\1' || chr(1), 'g'), chr(1)) AS m
                    FROM texts)))
            ) WHERE {valid} AND {score} >= 0.7""")
    spans = " UNION ALL ".join(parts)
    shown = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY place, s)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in ("email", "ip", "card", "phone"))
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        spans AS ({spans}),
        sums AS (SELECT doc_id, {counts}, {shown} FILTER (place <= 4) AS base, {shown} AS spans FROM spans GROUP BY doc_id)
        SELECT t.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
          coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts t LEFT JOIN sums USING (doc_id)"""


def _decontamination() -> str:
    """Windows of items are compared with windows of documents of the same length."""
    cut = f"regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
        WITH docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce({cut}, []) AS w FROM documents),
        items AS (SELECT item_id, {cut} AS w FROM benchmark WHERE text IS NOT NULL),
        windows AS (
          SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS t
          FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM windows),
        places AS (
          SELECT k, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
          FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)),
        hits AS (SELECT k, i, n, item_id FROM places JOIN windows USING (n, t)),
        words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hits) GROUP BY k),
        found AS (
          SELECT k, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
          FROM (SELECT DISTINCT k, item_id FROM hits) GROUP BY k)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN words USING (k) LEFT JOIN found USING (k)"""


def _urls() -> str:
    """The template tree level by level, over whole rows instead of counted ones."""
    rules = (("www.example.com", "/en/", 0), ("example.com", "/en/", 1), ("net", "/es/", 1), ("net", "/fr/", 1), ("com", "/", 0))
    fits = "[" + ", ".join(
        f"CASE WHEN ('.' || host) LIKE '%.{host}' AND starts_with(path, '{path}') THEN {{'r': '{host}{path}', 'bad': {bad}}} END"
        for host, path, bad in rules
    ) + "]"
    steps = []
    for level in range(1, 5):
        steps.append(f"""
        s{level} AS (SELECT *, CASE WHEN regexp_matches(seg, '[0-9]') THEN '*' ELSE seg END AS segment
          FROM (SELECT *, coalesce(rest[{level}], '') AS seg FROM t{level - 1})),
        v{level} AS (SELECT *, CASE WHEN fan >= 10 AND 2 * fan >= urls AND segment <> '' THEN '*' ELSE segment END AS name
          FROM (SELECT *, count(DISTINCT segment) OVER (PARTITION BY host, tpl) AS fan, count(*) OVER (PARTITION BY host, tpl) AS urls FROM s{level})),
        m{level} AS (SELECT *, count(bad) OVER w AS l, coalesce(sum(bad) OVER w, 0) AS b,
            count(bad) OVER p AS al, coalesce(sum(bad) OVER p, 0) AS ab
          FROM v{level} WINDOW w AS (PARTITION BY host, tpl, name), p AS (PARTITION BY host, tpl)),
        t{level} AS (SELECT k, page_id, host, path, rule, bad, rest,
            CASE WHEN name = '' THEN tpl
                 WHEN l > 0 AND (b * al - l * ab)::DOUBLE * (b * al - l * ab) <= 4.0 * l * ab * (al - ab) THEN tpl || '/~'
                 ELSE tpl || '/' || name END AS tpl
          FROM m{level})""")
    return f"""
        WITH cut AS (SELECT row_number() OVER () AS k, page_id, coalesce(url, '') AS u, strpos(coalesce(url, ''), '://') AS p0 FROM pages),
        tail AS (SELECT k, page_id, CASE WHEN p0 > 0 THEN substr(u, p0 + 3) ELSE '' END AS t FROM cut),
        split AS (SELECT k, page_id, translate(regexp_extract(t, '^[^/?#]*'), '{_UP}', '{_LOW}') AS host,
            regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM tail),
        ruled AS (SELECT *, list_filter({fits}, lambda x: x IS NOT NULL)[1] AS hit FROM split),
        t0 AS (SELECT k, page_id, host, path, hit.r AS rule, hit.bad AS bad, '' AS tpl,
            list_filter(string_split(path, '/'), lambda x: x <> '') AS rest FROM ruled),
        {", ".join(steps)}
        SELECT page_id, host, path, rule,
          CASE WHEN CASE WHEN rule IS NOT NULL THEN bad = 1
                         ELSE (coalesce(sum(bad) OVER (PARTITION BY host, tpl), 0) + 1) / (count(bad) OVER (PARTITION BY host, tpl) + 2) >= 0.6 END
            THEN 'block' ELSE 'allow' END AS verdict
        FROM t4"""


_CRC_TABLE = """
        crc_table AS (
          SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def _crc(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes; ``tab`` is the only column of ``crc_table``."""
    octets = f"list_transform(range(strlen({text})), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    rest = f"list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))"
    return f"xor({rest}, 4294967295)"


def _manifest() -> str:
    """Both trees level by level from ranks of whole tables."""
    framed = "coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    fixed = " || ".join(framed.format(c=c) for c in ("doc_id", "source", "lang", "n_chars"))

    def tree(name: str, key: str) -> str:
        return f"""
        {name} AS (
          SELECT {key}, r, n, h, 0 AS level FROM {name}_leaves
          UNION ALL
          SELECT {key}, r // 3, (any_value(n) + 2) // 3, sha256(string_agg(h, '' ORDER BY r)), any_value(level) + 1
          FROM {name} WHERE n > 1 GROUP BY {key}, r // 3),
        {name}_siblings AS (
          SELECT a.{key}, a.level, a.r, coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r < a.r), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.r) FILTER (b.r > a.r), '') AS g
          FROM {name} a JOIN {name} b ON a.{key} = b.{key} AND a.level = b.level AND a.r // 3 = b.r // 3
          WHERE a.n > 1 GROUP BY a.{key}, a.level, a.r)"""

    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        hashed AS (
          SELECT *, sha256({fixed} || {framed.format(c="text")}) AS h, sha256({fixed} || {framed.format(c="cut")}) AS cut_h
          FROM (SELECT *, coalesce('=' || source, '') AS k, CASE WHEN {_crc("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut
                FROM documents, crc_table)),
        tree_leaves AS (
          SELECT doc_id, k, h, cut_h, row_number() OVER (PARTITION BY k ORDER BY doc_id, h) - 1 AS r, count(*) OVER (PARTITION BY k) AS n FROM hashed),
        {tree("tree", "k")},
        over_leaves AS (
          SELECT 'all' AS k, k AS source, h, row_number() OVER (ORDER BY k) - 1 AS r, count(*) OVER () AS n
          FROM tree WHERE n = 1),
        {tree("over", "k")},
        folds AS (
          SELECT doc_id, k, r, 0 AS level, cut_h AS folded, '' AS siblings FROM tree_leaves
          UNION ALL
          SELECT f.doc_id, f.k, f.r // 3, f.level + 1, sha256(l || folded || g), siblings || l || g
          FROM folds f JOIN tree_siblings s ON f.k = s.k AND f.level = s.level AND f.r = s.r),
        halfway AS (SELECT * FROM folds QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1),
        outer_folds AS (
          SELECT doc_id, o.r, 0 AS level, folded, siblings, o.h AS subroot FROM halfway JOIN over_leaves o ON o.source = halfway.k
          UNION ALL
          SELECT f.doc_id, f.r // 3, f.level + 1, sha256(l || folded || g), siblings || l || g, subroot
          FROM outer_folds f JOIN over_siblings s ON f.level = s.level AND f.r = s.r),
        done AS (SELECT * FROM outer_folds QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY level DESC) = 1)
        SELECT doc_id, t.h AS leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root, folded = root AS verified
        FROM tree_leaves t JOIN done USING (doc_id), (SELECT h AS root FROM over WHERE n = 1)"""


def _spelling() -> str:
    """Near words meet through the word without its letter at a place; all steps of a chain of forms in one recursion."""
    return f"""
        WITH RECURSIVE {_CRC_TABLE},
        runs AS (
          SELECT doc_id, run, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UP}', '{_LOW}'), '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents)
          WHERE length(run) >= 7 GROUP BY doc_id, run),
        read AS (
          SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
          FROM (SELECT run, n, {_crc("(doc_id || ':' || run)")} AS h FROM runs, crc_table)),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM read WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
          FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
        met AS (
          SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word FROM words a JOIN cuts b ON a.word = b.rest
          UNION SELECT b.word, a.word FROM words a JOIN cuts b ON a.word = b.rest),
        near AS (
          SELECT a, count(*) AS n_near, first(b ORDER BY w.n DESC, encode(b)) AS b, max(w.n) AS n_b
          FROM met JOIN words w ON met.b = w.word GROUP BY a),
        known AS (
          SELECT word, CASE WHEN n_b >= 10 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near, CASE WHEN n_b >= 10 * n THEN n_b END AS form_n
          FROM words LEFT JOIN near ON word = a),
        walk AS (
          SELECT word, word AS spot, 0 AS steps FROM known
          UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN known ON walk.spot = known.word WHERE form IS NOT NULL)
        SELECT k.word, form, root, n, n_near, form_n
        FROM known k JOIN (SELECT word, first(spot ORDER BY steps DESC) AS root FROM walk GROUP BY word) r USING (word)"""


ORACLES = {"op3_url_filter": _urls(), "op7_decontamination": _decontamination(), "op10_personal_data": _pii(), "op11_merkle_manifest": _manifest(), "op12_spelling_groups": _spelling()}
