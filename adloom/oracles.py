"""The results of the core training-data operators in plain SQL, written apart
from the operators and without look-around, to be compared with them."""

from __future__ import annotations

from adloom.operators import units

quote = lambda s: "'" + s.replace("'", "''") + "'"


def _tokens(table: dict[str, list[str]]) -> str:
    """Alternation of aliases as they stand in a text whose tokens are parted by
    blanks, longest first."""
    names = {" ".join(a.replace("/", " / ").split()) for names in table.values() for a in names}
    return "|".join("".join("\\" + ch if ch in ".$+()" else ch for ch in a) for a in sorted(names, key=lambda a: (-len(a), a)))


def _unit_of(column: str, table: dict[str, list[str]]) -> str:
    pick = " ".join(f"WHEN {column} IN ({', '.join(quote(' '.join(a.replace('/', ' / ').split())) for a in names)}) THEN {quote(unit)}" for unit, names in table.items())
    return f"CASE {pick} END"


def pay(unconverted: bool = False) -> str:
    """p5_found: the text is parted into tokens by blanks, then read by patterns
    that begin each token with a blank. Or p5_unconverted: what lacks a rate or
    a unit (all currencies of these tables are known ones)."""
    n, s, c, p = r"([0-9]+(?:\.[0-9]{1,2})?)", _tokens(units.SCALES), _tokens(units.CURRENCIES), _tokens(units.PERIODS)
    pair = rf" {n}(?: ({s}))?(?: (?:{c}))? (?:-|to|až|do|bis|and)(?: (?:{c}))? {n}(?: ({s}))? "
    one = rf" {n}(?: ({s}))? "
    gone = r"\d+ (?:týdn|dn)\p{L}* dovolen\p{L}*|1[34]\. plat\p{L}*|(?:tarifní )?třída ?\d*|401 ?\(?k\)?|(?:až |do |up to )?\d+(?:[.,]\d+)? ?%"
    group = r"(\d)[ .,''’](\d{3})([^0-9]|$)"
    degroup = lambda x: rf"regexp_replace({x}, '{group}', '\1\2\3', 'g')"
    t = r"""lower(trim(regexp_replace("Salary", '[\s\p{Z}]+', ' ', 'g')))"""
    t = rf"regexp_replace({t}, '\([^()]*\)', ' ', 'g')"
    t = rf"regexp_replace(regexp_replace({t}, '\s\+\s.*$', ''), ',-+', ' ', 'g')"
    t = degroup(degroup(degroup(f"regexp_replace({t}, '{gone}', ' ', 'g')")))
    t = rf"regexp_replace({t}, '(\d),(\d{{1,2}})([^0-9]|$)', '\1.\2\3', 'g')"
    t = rf"regexp_replace({t}, '([-–—/])', ' \1 ', 'g')"
    t = rf"regexp_replace(regexp_replace({t}, '(\d)(\p{{L}}|[€$£])', '\1 \2', 'g'), '(\p{{L}}|[€$£])(\d)', '\1 \2', 'g')"
    t = rf"' ' || trim(regexp_replace(regexp_replace({t}, '[–—]', '-', 'g'), '\s+', ' ', 'g')) || ' '"
    cut = lambda pattern, k: f"nullif(regexp_extract(t, {quote(pattern)}, {k}), '')"
    open_top, open_bottom = units.OPEN_TOP, units.OPEN_BOTTOM
    value = lambda amount, scale: f"round(CAST(CAST({amount} AS DECIMAL(20,4)) * coalesce(CAST({scale} AS BIGINT), 1) AS DECIMAL(18,2)) * czk * month_num / month_den)"
    read = rf"""WITH s AS (SELECT row_id, regexp_extract("ID", '^([A-Za-z]+)', 1) AS prefix, {t} AS t FROM data_analytics WHERE regexp_matches("Salary", '[0-9]')),
k AS (SELECT *, regexp_matches(t, {quote(pair)}) AS two FROM s WHERE regexp_matches(t, '[0-9]')),
r AS (SELECT row_id, prefix, two, CASE WHEN two THEN {cut(pair, 1)} ELSE {cut(one, 1)} END AS lo, CASE WHEN two THEN {cut(pair, 2)} ELSE {cut(one, 2)} END AS ls,
CASE WHEN two THEN {cut(pair, 3)} END AS hi, CASE WHEN two THEN {cut(pair, 4)} END AS hs,
CASE WHEN two THEN 'both' WHEN regexp_matches(t, {quote(rf"^[^0-9]*[ :](?:{open_bottom})(?: (?:{c}))? [0-9]")}) THEN 'max'
WHEN regexp_matches(t, {quote(rf"^[^0-9]*[ :](?:{open_top})(?: (?:{c}))? [0-9]")}) OR regexp_matches(t, '[0-9] ?\+ *$') THEN 'min' ELSE 'both' END AS side,
{cut(f" ({c}) ", 1)} AS c, {cut(f" ({p}) ", 1)} AS p FROM k),
u AS (SELECT row_id, lo, hi, side, {_unit_of("ls", units.SCALES)} AS lx, {_unit_of("hs", units.SCALES)} AS hx, coalesce({_unit_of("c", units.CURRENCIES)}, d.currency) AS cur, coalesce({_unit_of("p", units.PERIODS)}, d.pay_unit) AS unit
FROM r LEFT JOIN board_defaults d ON d.id_prefix = prefix WHERE lo IS NOT NULL)"""
    if unconverted:
        return rf"""{read}
SELECT row_id, CASE WHEN cur IS NULL THEN 'no currency' WHEN f.currency IS NULL THEN 'no rate' ELSE 'no period' END AS reason
FROM u LEFT JOIN fx_rates f ON f.currency = cur LEFT JOIN pay_units y ON y.unit = u.unit WHERE f.currency IS NULL OR y.unit IS NULL"""
    return rf"""{read},
m AS (SELECT row_id, side, {value("lo", "CASE WHEN lx IS NULL AND CAST(lo AS DOUBLE) <= CAST(hi AS DOUBLE) THEN hx ELSE lx END")} AS low, {value("hi", "hx")} AS high
FROM u JOIN fx_rates f ON f.currency = cur JOIN pay_units y ON y.unit = u.unit)
SELECT row_id, CAST(CASE WHEN side = 'max' THEN -1 ELSE low END AS BIGINT) AS low_czk, CAST(CASE WHEN side = 'min' THEN -1 ELSE coalesce(high, low) END AS BIGINT) AS high_czk FROM m"""


def instants() -> str:
    """p2_found: each shape of a value has a row of its own in a union; a wall
    time that occurs twice is moved to the first by a look one hour back."""
    from adloom.operators import timestamps as ts

    months = ", ".join(f"({quote(n)}, {k})" for k, names in ts.MONTHS.items() for n in names.split())
    zones = ", ".join(f"({quote(z)}, {s})" for z, s in ts.ABBREVIATIONS.items())
    cells = " UNION ALL ".join(f"SELECT row_id, \"Source\" AS source, '{f}' AS field, \"{f}\" AS raw FROM prospects_enriched_raw" for f in ("Mining_Date", "Published_At", "Valid_Through"))
    clock, zone = r"([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.,]([0-9]+))?)? ?", r"(z|[a-z]{3,4}|[+-][0-9]{2}:?[0-9]{2}|\[[a-z_]+/[a-z_/]+\])?"
    shapes = [  # pattern, groups of y m d h mi s f, half day, zone
        (rf"^([0-9]{{4}})-([0-9]{{2}})-([0-9]{{2}})(?:[t ]{clock}{zone})?$", (1, 2, 3, 4, 5, 6, 7, 0, 8), ""),
        (rf"^([0-9]{{4}})([0-9]{{2}})([0-9]{{2}})(?:t([0-9]{{2}})([0-9]{{2}})([0-9]{{2}}){zone})?$", (1, 2, 3, 4, 5, 6, 0, 0, 7), ""),
        (r"^([0-9]{1,2})\. ?([0-9]{1,2})\. ?([0-9]{4})(?:,? (?:v )?([0-9]{1,2})[:.]([0-9]{2})(?: hod\.)?)?$", (3, 2, 1, 4, 5, 0, 0, 0, 0), ""),
        (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?: ([0-9]{1,2}):([0-9]{2}))?$", (3, 2, 1, 4, 5, 0, 0, 0, 0), "AND date_order = 'day_first'"),
        (r"^([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})(?: ([0-9]{1,2}):([0-9]{2}))?$", (3, 1, 2, 4, 5, 0, 0, 0, 0), "AND date_order = 'month_first'"),
        (rf"^(?:\p{{L}}{{3}}, )?([0-9]{{1,2}})\.? (\p{{L}}+) ([0-9]{{4}})(?: {clock}{zone})?$", (3, 2, 1, 4, 5, 6, 7, 0, 8), ""),
        (rf"^(\p{{L}}+) ([0-9]{{1,2}}), ([0-9]{{4}})(?: {clock}(am|pm)?)?$", (3, 1, 2, 4, 5, 6, 7, 8, 0), ""),
    ]
    part = lambda pattern, k: f"regexp_extract(v, {quote(pattern)}, {k})" if k else "''"
    names = ("y", "mo", "da", "h", "mi", "se", "fr", "half", "z")
    read = " UNION ALL ".join(
        f"SELECT row_id, field, zone, {', '.join(f'{part(p, g)} AS {n}' for n, g in zip(names, groups))} FROM c WHERE regexp_matches(v, {quote(p)}) {more}" for p, groups, more in shapes
    )
    epochs = " UNION ALL ".join(f"SELECT row_id, field, try_cast(v AS BIGINT) * {m} AS utc_us FROM c WHERE regexp_matches(v, '^[0-9]{{{n}}}$')" for n, m in ((10, 1_000_000), (13, 1_000), (16, 1)))
    return rf"""WITH months(name, number) AS (VALUES {months}), abbr(name, ahead) AS (VALUES {zones}),
c AS (SELECT row_id, field, coalesce(zone, 'UTC') AS zone, date_order, lower(trim(regexp_replace(raw, '[\s\p{{Z}}]+', ' ', 'g'))) AS v FROM ({cells}) x LEFT JOIN board_defaults b USING (source) WHERE raw IS NOT NULL),
r AS ({read}),
n AS (SELECT row_id, field, zone, z, try_cast(rpad(left(fr, 6), 6, '0') AS BIGINT) AS us, y || '-' || lpad(CAST(coalesce(try_cast(mo AS INTEGER), number) AS VARCHAR), 2, '0') || '-' || lpad(da, 2, '0') AS day,
CASE half WHEN 'pm' THEN try_cast(h AS INTEGER) % 12 + 12 WHEN 'am' THEN try_cast(h AS INTEGER) % 12 ELSE coalesce(try_cast(h AS INTEGER), 0) END AS hour, mi, se FROM r LEFT JOIN months m ON m.name = mo),
t AS (SELECT row_id, field, zone, z, us, try_cast(day || ' ' || lpad(CAST(hour AS VARCHAR), 2, '0') || ':' || lpad(CASE mi WHEN '' THEN '00' ELSE mi END, 2, '0') || ':' || lpad(CASE se WHEN '' THEN '00' ELSE se END, 2, '0') AS TIMESTAMP) AS wall FROM n),
w AS (SELECT *, CASE WHEN z LIKE '[%' THEN (SELECT any_value(p.name) FROM pg_timezone_names() p WHERE lower(p.name) = z[2:-2]) ELSE zone END AS place, regexp_extract(z, '([+-])', 1) AS sign, regexp_extract(z, '([0-9]{{2}})', 1) AS oh, regexp_extract(z, '([0-9]{{2}})$', 1) AS om FROM t WHERE wall IS NOT NULL),
u AS (SELECT row_id, field, us, CASE WHEN z = '' OR z LIKE '[%' THEN CASE WHEN timezone(place, timezone(place, wall) - INTERVAL 1 HOUR) = wall THEN timezone(place, wall) - INTERVAL 1 HOUR ELSE timezone(place, wall) END END AS local,
CASE WHEN sign <> '' THEN (try_cast(oh AS BIGINT) * 3600 + try_cast(om AS BIGINT) * 60) * CASE sign WHEN '-' THEN -1 ELSE 1 END ELSE a.ahead END AS ahead, wall FROM w LEFT JOIN abbr a ON a.name = z)
SELECT row_id, field, utc_us FROM (SELECT row_id, field, coalesce(epoch_us(local), epoch_us(wall) - ahead * 1000000) + coalesce(us, 0) AS utc_us FROM u UNION ALL {epochs}) WHERE utc_us IS NOT NULL"""


def header_changes() -> str:
    """p4_found by brute force: every line of a file is laid beside every line
    of the file before, and goes with the one that shares most of its values."""
    return r"""WITH f AS (SELECT file_id, lag(file_id) OVER (PARTITION BY feed ORDER BY min(written_at), file_id) AS prev FROM raw_records GROUP BY file_id, feed),
c AS (SELECT r.file_id, r.line_no, e.key AS name, CASE e.type WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN NULL ELSE 'number' END AS type,
CASE e.type WHEN 'NULL' THEN NULL WHEN 'ARRAY' THEN array_to_string(json_extract_string(e.value, '$[*]'), ', ') WHEN 'OBJECT' THEN json_extract_string(e.value, '$.' || '"' || json_keys(e.value)[1] || '"') ELSE json_extract_string(e.value, '$') END AS content
FROM raw_records r, json_each(r.record) e WHERE json_valid(r.record)),
t AS (SELECT file_id, name, type, count(*) AS n FROM c GROUP BY ALL),
h AS (SELECT file_id, name, arg_max(type, n) FILTER (type IS NOT NULL) AS type FROM t GROUP BY ALL),
b AS (SELECT coalesce(x.file_id, p.file_id) AS file_id, coalesce(x.name, p.name) AS name, x.type AS now, p.type AS was, x.name IS NOT NULL AS here, p.name IS NOT NULL AS there
FROM (SELECT f.file_id, h.name, h.type FROM f JOIN h USING (file_id) WHERE prev IS NOT NULL) x FULL JOIN (SELECT f.file_id, h.name, h.type FROM f JOIN h ON h.file_id = f.prev) p ON x.file_id = p.file_id AND x.name = p.name),
g AS (SELECT file_id, prev FROM f WHERE file_id IN (SELECT file_id FROM b WHERE here AND NOT there) AND file_id IN (SELECT file_id FROM b WHERE there AND NOT here)),
v AS (SELECT g.file_id, a.line_no AS p, q.line_no AS q, count(*) AS votes FROM g JOIN (SELECT DISTINCT file_id, line_no, content FROM c WHERE length(content) >= 6) a ON a.file_id = g.prev
JOIN (SELECT DISTINCT file_id, line_no, content FROM c WHERE length(content) >= 6) q ON q.file_id = g.file_id AND q.content = a.content GROUP BY ALL),
l AS (SELECT file_id, q, arg_max(p, (votes, -p)) AS p, max(votes) AS votes FROM v GROUP BY ALL HAVING max(votes) > 2),
s AS (SELECT o.file_id, o.name AS old, n.name AS new, avg(CAST(x.content = y.content AS INTEGER)) AS same FROM b o JOIN b n ON n.file_id = o.file_id AND n.here AND NOT n.there JOIN g ON g.file_id = o.file_id JOIN l ON l.file_id = o.file_id
JOIN c x ON x.file_id = g.prev AND x.line_no = l.p AND x.name = o.name JOIN c y ON y.file_id = g.file_id AND y.line_no = l.q AND y.name = n.name
WHERE o.there AND NOT o.here AND x.content IS NOT NULL AND y.content IS NOT NULL GROUP BY ALL HAVING avg(CAST(x.content = y.content AS INTEGER)) >= 0.3),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY file_id, old ORDER BY same DESC, new) = 1 AND row_number() OVER (PARTITION BY file_id, new ORDER BY same DESC, old) = 1)
SELECT file_id, 'added' AS change, name AS column_name FROM b WHERE here AND NOT there AND (file_id, name) NOT IN (SELECT (file_id, new) FROM m)
UNION ALL SELECT file_id, 'removed', name FROM b WHERE there AND NOT here AND (file_id, name) NOT IN (SELECT (file_id, old) FROM m)
UNION ALL SELECT file_id, 'renamed', new FROM m
UNION ALL SELECT m.file_id, 'retyped', new FROM m JOIN b o ON o.file_id = m.file_id AND o.name = old JOIN b n ON n.file_id = m.file_id AND n.name = new WHERE o.was <> n.now
UNION ALL SELECT file_id, 'retyped', name FROM b WHERE here AND there AND was <> now"""


def split_values() -> str:
    """p3_found by a splitter that is told how slashes are set here: one with a
    blank or an end beside it parts values, a tight one doesn't."""
    piece, blank = r"(?:\"(?:[^\"]|\"\")*\"|[^\",;|•·\t\n\r\x{2028}]|\")+", r"[\s\p{Z}]"
    atom = r"(?:\"(?:[^\"]|\"\")*\"|[^\"/]|\")+"
    cells = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, row_id, '{f}' AS field, \"{f}\" AS cell FROM {t}"
        for t, fields in (("data_analytics", ("Tags", "Technology", "Caution.Flags")), ("prospect_reviews", ("Review_Reasons",))) for f in fields
    )
    trim = lambda x: f"regexp_replace({x}, '^{blank}+|{blank}+$', '', 'g')"
    hidden = lambda x: rf"regexp_replace(regexp_replace({x}, '([^\s\p{{Z}}/])/([^\s\p{{Z}}/])', '\1\x01\2', 'g'), '([^\s\p{{Z}}/])/([^\s\p{{Z}}/])', '\1\x01\2', 'g')".replace(r"\x01", "\x01")
    bare = f"CASE WHEN length(v) > 1 AND v[1] = '\"' AND v[-1] = '\"' THEN {trim('''replace(v[2:-2], '\"\"', '\"')''')} ELSE v END"
    return rf"""WITH c AS (SELECT *, {trim("cell")} AS t FROM ({cells}) WHERE regexp_matches(cell, '[^\s\p{{Z}}]')),
j AS (SELECT *, t LIKE '[%]' AND json_valid(t) AS js FROM c),
p AS (SELECT table_name, row_id, field, CASE WHEN js THEN CAST(CAST(t AS JSON) AS VARCHAR[]) ELSE list_filter(flatten(list_transform(regexp_extract_all(t, '{piece}'), lambda x: list_transform(regexp_extract_all({hidden(trim("x"))}, '{atom}'), lambda y: {trim("replace(y, chr(1), '/')")}))), lambda v: v <> '') END AS vs, js FROM j),
q AS (SELECT table_name, row_id, field, list_filter(list_transform(vs, lambda v: CASE WHEN js THEN {trim("v")} ELSE {bare} END), lambda v: v <> '') AS vs FROM p)
SELECT table_name, row_id, field, CAST(position AS BIGINT) AS position, value FROM (SELECT table_name, row_id, field, unnest(vs) AS value, generate_subscripts(vs, 1) AS position FROM q WHERE len(vs) > 1)"""
