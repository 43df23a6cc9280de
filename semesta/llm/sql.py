"""DuckDB SQL of queries that need checksums and hashes, which are spelled out here in plain arithmetic."""

from __future__ import annotations

# The primes of XXH64, the seed that Spark starts from, and the polynomial of CRC-32.
PRIMES = (
    11400714785074694791,
    14029467366897019727,
    1609587929392839161,
    9650029242287828579,
    2870177450012600261,
)
SPARK_SEED = 42
POLYNOMIAL = 3988292384

#: Two CTEs: CRC-32 of each byte value, as one list; it is joined to rows whose ``crc32`` is wanted.
CRC_RULE = f"""rule AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, step: if(c % 2 = 1, xor(c // 2, {POLYNOMIAL}), c // 2)) ORDER BY n) AS bytes FROM range(256) r(n))"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; the rows are joined with ``rule``."""
    digits = "123456789ABCDEF"
    values = f"""list_transform(regexp_extract_all(hex({text}), '..'),
        lambda h: 16 * instr('{digits}', left(h, 1)) + instr('{digits}', right(h, 1)))"""
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {values}), lambda c, b: xor(c // 256, bytes[xor(c % 256, b) + 1])))"


def _wrapped(value: str) -> str:
    return f"(({value}) % {1 << 64}::UHUGEINT)"


def _times(value: str, prime: int) -> str:
    return _wrapped(f"{value} * {PRIMES[prime - 1]}::UHUGEINT")


def _rotated(value: str, bits: int) -> str:
    return f"({_wrapped(f'{value} * {1 << bits}::UHUGEINT')} + {value} // {1 << (64 - bits)}::UHUGEINT)"


def _shifted(value: str, bits: int) -> str:
    return f"xor({value}, {value} // {1 << bits}::UHUGEINT)"


def xxhash64(source: str, columns: list[tuple[str, int]], name: str) -> str:
    """``source`` with Spark's signed hash of integer columns; each comes with its number of bytes, 4 or 8.

    NULL leaves the hash as it is.
    """
    query = f"(SELECT *, {SPARK_SEED}::UHUGEINT AS h FROM {source})"
    for column, size in columns:
        value = f"(CASE WHEN {column} < 0 THEN {1 << 8 * size}::HUGEINT + {column} ELSE {column} END)::UHUGEINT"
        begun = _wrapped(f"h + {PRIMES[4] + size}::UHUGEINT")
        if size == 8:
            steps = [
                f"xor({begun}, {_times(_rotated(_times(value, 2), 31), 1)})",
                _wrapped(f"{_times(_rotated('h', 27), 1)} + {PRIMES[3]}::UHUGEINT"),
            ]
        else:
            steps = [
                f"xor({begun}, {_times(value, 1)})",
                _wrapped(f"{_times(_rotated('h', 23), 2)} + {PRIMES[2]}::UHUGEINT"),
            ]
        steps += [_times(_shifted("h", 33), 2), _times(_shifted("h", 29), 3), _shifted("h", 32)]
        for step in steps:
            query = f"(SELECT * REPLACE (CASE WHEN {column} IS NULL THEN h ELSE {step} END AS h) FROM {query})"
    signed = f"(CASE WHEN h >= {1 << 63}::UHUGEINT THEN h::HUGEINT - {1 << 64}::HUGEINT ELSE h::HUGEINT END)::BIGINT"
    return f"(SELECT * EXCLUDE (h), {signed} AS {name} FROM {query})"


def shards(count: int, seed: int) -> str:
    """Proportional interleaving: the rank within a source, as a fraction, orders the rows; equal runs are the shards."""
    sized = f"""(SELECT doc_id, source, coalesce('=' || source, '') AS stratum, octet_length(encode(coalesce(text, ''))) + 16 AS size,
        ({crc32("coalesce(text, '')")})::BIGINT AS text_crc32, {seed} AS seed FROM documents, rule)"""
    drawn = xxhash64(sized, [("doc_id", 8), ("size", 8), ("text_crc32", 8), ("seed", 4)], "drawn")
    order = "drawn, doc_id NULLS FIRST, size, text_crc32"
    return f"""WITH {CRC_RULE}, drawn_rows AS MATERIALIZED (SELECT * FROM {drawn}),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY stratum ORDER BY {order}) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY stratum) AS fraction
    FROM drawn_rows),
placed AS (SELECT *, row_number() OVER (ORDER BY fraction, stratum, {order}) - 1 AS place, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, (place * {count} // total)::INT AS shard,
    place - ((place * {count} // total) * total + {count - 1}) // {count} AS slot, NULL::INT AS grown_shard, source FROM placed"""


def repaired() -> str:
    """Damage and cheapest repair of every conversation: a fold over its rows of the best way to each of four states."""
    # What is expected in a state: after nothing, a system, a user, an assistant turn.
    follow = ("user", "user", "assistant", "user")
    after = (2, 2, 3, 2)
    never = "{'cost': 1000000000000, 'audit': '~', 'said': ''}"

    def way(held: str, letter: str, cost: str, line: str = "") -> str:
        said = f"if({held}.said = '', '', {held}.said || chr(10)) || {line}" if line else f"{held}.said"
        return f"{{'cost': {held}.cost + {cost}, 'audit': {held}.audit || '{letter}', 'said': {said}}}"

    def least(ways: list[str]) -> str:
        return f"list_sort([{', '.join(ways)}])[1]" if len(ways) > 1 else ways[0]

    def step() -> list[str]:
        """Ways to each state by keeping, renaming or deleting a row r, from the states s before it."""
        ways: list[list[str]] = [[way(f"s.w{i}", "D", "3")] for i in range(4)]
        cut = "if(r.fault = 'truncated', 1, 0)"
        lost = "r.fault IN ('blank', 'duplicate')"
        for i in range(4):
            keep, rename = way(f"s.w{i}", "K", cut, "r.role || ':' || r.said"), way(f"s.w{i}", "R", f"2 + {cut}", f"'{follow[i]}:' || r.said")
            ways[after[i]].append(f"if({lost} OR left(r.role, 1) <> '{follow[i][0]}', {never}, {keep})")
            ways[after[i]].append(f"if({lost}, {never}, {rename})")
            if i == 0:
                system = way("s.w0", "K", cut, "r.role || ':' || r.said")
                ways[1].append(f"if({lost} OR left(r.role, 1) <> 's', {never}, {system})")
        return [least(x) for x in ways]

    fields = "'role': ''::VARCHAR, 'said': ''::VARCHAR, 'fault': ''::VARCHAR"

    begin = "{'cost': 0, 'audit': '', 'said': ''}"
    first = f"{{'w0': {begin}, 'w1': {never}, 'w2': {never}, 'w3': {never}, {fields}}}"

    def states(changed: dict[int, str]) -> str:
        return ", ".join(f"'w{i}': {changed.get(i, f's.w{i}')}" for i in range(4))

    # Each row is three steps of the fold: the row itself, then a user and then an assistant that are put in.
    row = states(dict(enumerate(step())))
    users = states({2: least(["s.w2", *(way(f"s.w{i}", "I", "2", "'user:'") for i in (0, 1, 3))])})
    replies = states({3: least(["s.w3", way("s.w2", "I", "2", "'assistant:'")])})
    element = f"'w0': {never}, 'w1': {never}, 'w2': {never}, 'w3': {never}"
    return f"""WITH {CRC_RULE},
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS hit FROM conversations, rule),
damaged AS (SELECT conv_id, turn, if(hit = 4, 'user', role) AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM hit JOIN (VALUES (1), (2)) copies(copy) ON hit <> 0 AND (copy = 1 OR hit = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place FROM damaged),
told AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) AS nth FROM placed),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS two FROM told),
steps AS (SELECT conv_id, flatten(list([{{{element}, 'role': role, 'said': text, 'fault': fault}},
    {{{element}, 'role': '', 'said': '', 'fault': 'users'}}, {{{element}, 'role': '', 'said': '', 'fault': 'replies'}}] ORDER BY place)) AS rows,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
folded AS (SELECT * EXCLUDE (rows), list_reduce(list_concat([{first}, {{{element}, 'role': '', 'said': '', 'fault': 'users'}},
    {{{element}, 'role': '', 'said': '', 'fault': 'replies'}}], rows), lambda s, r: CASE r.fault WHEN 'users' THEN {{{users}, {fields}}}
    WHEN 'replies' THEN {{{replies}, {fields}}} ELSE {{{row}, {fields}}} END) AS ways FROM steps),
done AS (SELECT *, list_sort([ways.w0, ways.w3])[1] AS best FROM folded)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(best.said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM c.conv_id"""


def runs() -> str:
    """Periodic runs by plain comparison: places that equal the one a period later, in stretches of at least three periods.

    Only periods with three equal words at multiples of the period are compared, as every run has such a place.
    """
    word = r"[^\x20\x09-\x0D]+"
    return f"""WITH {CRC_RULE},
split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{word}') AS words,
    {crc32("coalesce(doc_id::VARCHAR, '')")} AS h FROM documents, rule),
texts AS (SELECT row_number() OVER () AS t, doc_id, words, len(words) AS n, h % 10 = 0 AS planted,
    if(len(words) > 0, h // 10 % len(words), 0) AS a, 3 + h // 10 % 8 AS parts FROM split),
given AS (SELECT t, unnest(range(n)) AS i, unnest(words) AS w FROM texts),
places AS (SELECT t, n, a, 1 + (n - a) // parts AS p, planted, unnest(range(n)) AS i FROM texts),
said AS MATERIALIZED (SELECT x.t, n, x.i, w FROM places x JOIN given y
    ON y.t = x.t AND y.i = if(planted AND x.i >= a, a + (x.i - a) % p, x.i)),
grid AS (SELECT t, q, unnest(range(0, n - 2 * q, q)) AS i FROM (SELECT t, n, unnest(range(1, n // 4 + 1)) AS q FROM texts) AS periods),
one AS MATERIALIZED (SELECT g.*, w FROM grid g JOIN said USING (t, i)),
two AS MATERIALIZED (SELECT o.t, o.q, o.i, o.w, x.w AS next FROM one o JOIN said x ON x.t = o.t AND x.i = o.i + o.q),
three AS MATERIALIZED (SELECT o.t, o.q, o.w, x.w AS last FROM two o JOIN said x ON x.t = o.t AND x.i = o.i + 2 * o.q WHERE o.w = next),
periods AS MATERIALIZED (SELECT DISTINCT t, q FROM three WHERE w = last),
moved AS MATERIALIZED (SELECT p.t, p.q, x.i, x.w FROM periods p JOIN said x ON x.t = p.t),
paired AS MATERIALIZED (SELECT m.t, m.q, m.i, m.w, x.w AS next FROM moved m JOIN said x ON x.t = m.t AND x.i = m.i + m.q),
same AS (SELECT t, q, i, i - row_number() OVER (PARTITION BY t, q ORDER BY i) AS stretch FROM paired WHERE w = next),
long AS (SELECT t, q, min(i) AS start, count(*) + q AS length FROM same GROUP BY t, q, stretch
    HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS MATERIALIZED (SELECT t, start, length, min(q) AS period FROM long GROUP BY t, start, length),
told AS (SELECT t, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    max({{'length': length, 'before': -start, 'short': -period}}) AS best FROM runs GROUP BY t),
lost AS (SELECT DISTINCT t, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT t, string_agg(w, ' ' ORDER BY i) AS text FROM said ANTI JOIN lost USING (t, i) GROUP BY t)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.before AS start, best.length AS length, -best.short AS period,
    1000 * best.length // -best.short AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN told USING (t) LEFT JOIN kept USING (t)"""
