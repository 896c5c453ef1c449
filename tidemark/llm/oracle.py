"""Reference SQL (DuckDB) of the queries that SQL can express, written from the definitions.

Not expressed: network training and scoring (op1), context trees (op3), 64-bit hashes of shingles
(op5), the libraries' encoders (op6, op9) and the fitted classifier (op8); tests compare those with
slow versions, round trips or held-out accuracy.
"""

from __future__ import annotations

from . import chat_layout, curve_shards, template_leaks, url_alias

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def url_sql(rules: tuple[tuple[str, str, str], ...]) -> str:
    listed = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in rules)
    host = f"translate(regexp_extract({{0}}, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}')"
    path = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    rest = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"
    node = (f"CASE WHEN contains({{0}}, '://') THEN regexp_replace(translate(regexp_extract({{0}}, '(?s)^(.*?://[^/?#]*)', 1), '{_UPPER}', '{_LOWER}'),"
            f" {_quoted(url_alias.DEFAULT_PORT)}, '\\1\\2') || CASE WHEN starts_with({rest}, '/') THEN '' ELSE '/' END || {rest} END")
    return f"""
    WITH RECURSIVE rules(r_host, r_path, r_verdict) AS (VALUES {listed}),
    p AS (SELECT page_id, coalesce({host.format('url')}, '') AS host, coalesce({path.format('url')}, '') AS path,
                 {node.format('url')} AS node, url, html FROM pages),
    tags AS (SELECT url, unnest(regexp_extract_all(html, {_quoted(url_alias.TAG)})) AS tag FROM p),
    targets AS (
      SELECT url, replace(CASE WHEN regexp_matches(tag, {_quoted(url_alias.CANONICAL)}) THEN regexp_extract(tag, {_quoted(url_alias.HREF)}, 1)
                 WHEN regexp_matches(tag, {_quoted(url_alias.REFRESH)}) THEN regexp_extract(tag, {_quoted(url_alias.REFRESH_URL)}, 1) END,
                 '&amp;', '&') AS t FROM tags),
    full_targets AS (
      SELECT url, CASE WHEN regexp_matches(t, '(?i)^https?://') THEN t
                       WHEN t LIKE '//%' THEN regexp_extract(url, '^(.*?:)//', 1) || t
                       WHEN t LIKE '/%' THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || t END AS t
      FROM targets WHERE t <> ''),
    links AS (SELECT {node.format('url')} AS a, {node.format('t')} AS b FROM full_targets WHERE t IS NOT NULL),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(n, m) AS (SELECT a, a FROM both_ways UNION SELECT r.n, e.b FROM reach r JOIN both_ways e ON r.m = e.a),
    spots AS (SELECT host, path FROM p UNION SELECT {host.format('m')}, {path.format('m')} FROM reach),
    ranked AS (
      SELECT host, path, r_host || r_path AS rule, r_verdict AS verdict,
             row_number() OVER (PARTITION BY host, path ORDER BY length(r_host) DESC, length(r_path) DESC, r_verdict) AS k
      FROM spots JOIN rules ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)),
    ruled AS (SELECT host, path, rule, verdict FROM ranked WHERE k = 1),
    said AS (SELECT n, min(verdict) AS verdict FROM reach JOIN ruled ON host = {host.format('m')} AND path = {path.format('m')} GROUP BY n)
    SELECT page_id, p.host, p.path, rule, coalesce(ruled.verdict, said.verdict, 'allow') AS verdict
    FROM p LEFT JOIN ruled USING (host, path) LEFT JOIN said ON said.n = p.node
    """


def chat_sql() -> str:
    control = _quoted(chat_layout._ESCAPE)
    escaped = lambda c: f"regexp_replace({c}, {control}, '\\1{chat_layout.JOINER}\\2\\3', 'g')"
    marks = len(chat_layout.TURN) + len(chat_layout.TEXT) + len(chat_layout.END)
    probe = "'</s>[INST] ok [/INST]'"
    return f"""
    WITH given AS (
      SELECT conv_id, turn, role, text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', {probe}), (-7, 1, 'assistant', {probe})),
    t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum({marks} + length({escaped('role')}) + length({escaped('text')})) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id
    """


def near_vectors_sql(cosine: float) -> str:
    return f"""
    WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
    good AS (
      SELECT * FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      AND list_cosine_similarity(a.e, b.e) >= {cosine}),
    reach(n, m) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.n, l.b FROM reach r JOIN links l ON r.m = l.a),
    least AS (SELECT n AS vec_id, min(m) AS component_id FROM reach GROUP BY n),
    counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
    FROM v JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
    """


def leaks_sql(window: int, min_windows: int) -> str:
    t = template_leaks

    def marked(text: str, name: str, number: str, unit: str) -> str:
        out = f"lower(regexp_replace({text}, {_quoted(t.NAME_RUN)}, '\\1 {name} ', 'g'))"
        out = f"regexp_replace({out}, {_quoted(t.NUMBER_UNIT)}, ' {number} {unit} \\3', 'g')"
        second = number.replace("\\1", "\\2")
        return f"regexp_replace({out}, {_quoted(t.NUMBER_ONLY)}, '\\1 {second} ', 'g')"

    clean = f"regexp_replace(coalesce(text, ''), '{t.MARKS}', ' ', 'g')"
    plain = marked(clean, t.NAME, t.NUMBER, t.UNIT)
    valued = marked(clean, f"{t.NAME}\\2{t.CLOSE}", f"{t.NUMBER}\\1{t.CLOSE}", f"{t.UNIT}\\2{t.CLOSE}")
    words = f"list_filter(regexp_split_to_array({plain}, {_quoted(t.GAP)}), lambda w: w <> '')"
    values = f"regexp_extract_all({valued}, {_quoted(t.VALUED)})"
    slot = f"regexp_matches({{0}}, '^[{t.NAME}-{t.UNIT}]')"
    return f"""
    WITH i AS (SELECT item_id, {words} AS w, {values} AS v FROM benchmark),
    d AS (SELECT doc_id, {words} AS w, {values} AS v FROM documents),
    items AS (SELECT item_id, w, v, least(len(w), {window}) AS width FROM i WHERE len(w) > 0),
    item_windows AS (
      SELECT item_id, width, p - 1 AS item_pos, array_to_string(w[p:p + width - 1], ' ') AS win
      FROM (SELECT *, unnest(generate_series(1, len(w) - width + 1)) AS p FROM items)),
    doc_windows AS (
      SELECT doc_id, width, p - 1 AS pos, array_to_string(w[p:p + width - 1], ' ') AS win
      FROM (SELECT doc_id, w, width, unnest(generate_series(1, len(w) - width + 1)) AS p
            FROM d, (SELECT DISTINCT width FROM items) WHERE len(w) >= width)),
    hits AS (
      SELECT DISTINCT doc_id, item_id, width, item_pos, pos - item_pos AS align
      FROM doc_windows JOIN item_windows USING (width, win)),
    need AS (SELECT item_id, least(count(*), {min_windows}) AS need FROM item_windows GROUP BY item_id),
    aligned AS (
      SELECT doc_id, item_id, align, count(*) AS n_windows FROM hits JOIN need USING (item_id)
      GROUP BY doc_id, item_id, align, need HAVING count(*) >= need),
    kept AS (SELECT hits.* FROM hits JOIN aligned USING (doc_id, item_id, align)),
    covered AS (
      SELECT DISTINCT doc_id, item_id, align, unnest(generate_series(item_pos, item_pos + width - 1)) AS j FROM kept),
    slots AS (
      SELECT doc_id, item_id, align, j, items.v[j + 1] AS iv, d.v[j + align + 1] AS dv
      FROM covered JOIN items USING (item_id) JOIN d USING (doc_id) WHERE {slot.format('items.v[j + 1]')}),
    bad AS (
      SELECT DISTINCT x.doc_id, x.item_id, x.align, x.j FROM slots x JOIN slots y USING (doc_id, item_id, align)
      WHERE (x.iv = y.iv) <> (x.dv = y.dv)),
    broken AS (
      SELECT DISTINCT doc_id, item_id, align, item_pos FROM kept JOIN bad USING (doc_id, item_id, align)
      WHERE j >= item_pos AND j < item_pos + width),
    counted AS (
      SELECT doc_id, item_id, align, n_windows, n_windows - coalesce(n_broken, 0) AS n_consistent
      FROM aligned LEFT JOIN (SELECT doc_id, item_id, align, count(*) AS n_broken FROM broken GROUP BY ALL)
      USING (doc_id, item_id, align))
    SELECT doc_id, item_id, CAST(max(n_windows) AS INTEGER) AS n_windows, CAST(max(n_consistent) AS INTEGER) AS n_consistent
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_consistent DESC, n_windows DESC) AS k
          FROM counted JOIN need USING (item_id) WHERE n_consistent >= need)
    WHERE k = 1 GROUP BY doc_id, item_id
    """


# Checksum of each byte value; texts are folded byte by byte with it.
_CRC_TABLE = """
    crc_table AS (
      SELECT list(list_reduce(list_prepend(b, range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS crc
      FROM range(256) r(b))"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``; needs ``crc_table`` in the FROM clause."""
    parts = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {parts}),"
            " lambda c, b: xor(c >> 8, crc[CAST(xor(c & 255, b) AS INTEGER) + 1])), 4294967295)")


def shards_sql(n_shards: int) -> str:
    bits, dims = curve_shards.BITS, ("lang", "source", "size")
    rank, following = curve_shards.curve_states(len(dims))
    states = ", ".join(f"({row >> len(dims)}, {row % (1 << len(dims))}, {r}, {f})" for row, (r, f) in enumerate(zip(rank, following, strict=True)))
    cells = ", ".join(
        f"{d}_cells AS (SELECT {d}, CAST((sum(count(*)) OVER (ORDER BY {d} NULLS FIRST) - count(*)) * {1 << bits} // (SELECT count(*) FROM d) AS INTEGER) AS {d}_cell"
        f" FROM d GROUP BY {d})" for d in dims)
    digit = " + ".join(f"((({d}_cell >> k) & 1) << {i})" for i, d in enumerate(dims))
    return f"""
    WITH RECURSIVE {_CRC_TABLE}, states(state, digit, rank, next) AS (VALUES {states}),
    d AS (SELECT doc_id, coalesce(text, '') AS text, lang, source, CAST(coalesce(strlen(text), 0) + {curve_shards.ROW_BYTES} AS BIGINT) AS size FROM documents),
    {cells},
    points AS (
      SELECT d.*, {", ".join(f"{c}_cell" for c in dims)} FROM d {" ".join(f"JOIN {c}_cells ON d.{c} IS NOT DISTINCT FROM {c}_cells.{c}" for c in dims)}),
    walk(lang_cell, source_cell, size_cell, k, state, place) AS (
      SELECT DISTINCT lang_cell, source_cell, size_cell, {bits - 1}, 0, 0::BIGINT FROM points
      UNION ALL
      SELECT lang_cell, source_cell, size_cell, k - 1, s.next, (place << {len(dims)}) + rank
      FROM (SELECT *, {digit} AS dig FROM walk WHERE k >= 0) w JOIN states s ON s.state = w.state AND s.digit = w.dig),
    summed AS (SELECT doc_id, size, {_crc32("text")} AS text_crc32, place
               FROM points JOIN walk USING (lang_cell, source_cell, size_cell), crc_table WHERE k = -1),
    ordered AS (
      SELECT *, sum(size) OVER (ORDER BY place, text_crc32, size, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before,
             (SELECT sum(size) FROM d) AS total FROM summed),
    cut AS (SELECT *, CAST((2 * before + size) * {n_shards} // (2 * total) AS INTEGER) AS shard FROM ordered)
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY place, text_crc32, size, doc_id NULLS FIRST) - 1 AS slot,
           CAST(NULL AS INTEGER) AS grown_shard, place
    FROM cut
    """


def prefix_trie_sql() -> str:
    return f"""
    WITH {_CRC_TABLE},
    t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
    lists AS (
      SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS turns
      FROM t GROUP BY conv_id),
    own AS (SELECT conv_id, turns, {_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM lists, crc_table),
    whole AS (
      SELECT o.conv_id, list_concat(coalesce(g.turns[1:h], []), o.turns[h + 1:]) AS path
      FROM own o LEFT JOIN lists g ON g.conv_id = o.conv_id - o.conv_id % 100),
    prefixes AS (SELECT conv_id, d, path[1:d] AS p, d = len(path) AS last FROM (SELECT *, unnest(generate_series(0, len(path))) AS d FROM whole)),
    nodes AS (
      SELECT p, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
      FROM prefixes GROUP BY p, d),
    children AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (p)),
    below AS (
      SELECT p[1:up] AS p, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
             sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(p[depth].text) ELSE 0 END) AS saved
      FROM (SELECT *, unnest(generate_series(0, depth)) AS up FROM counted) GROUP BY 1)
    SELECT c.conv_id, c.depth, u.conv_id AS parent_conv_id, c.n_convs, c.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
           CAST(saved AS BIGINT) AS saved_tokens, c.ends_sha256
    FROM counted c JOIN below ON c.p = below.p LEFT JOIN nodes u ON c.depth > 0 AND u.p = c.p[1:c.depth - 1]
    """
