"""SQL (DuckDB) for the mixing query: the same draw, with its own constants."""

from __future__ import annotations

_ROUNDS = 16


def _hex(digits: str) -> str:
    return f"('0x' || {digits})::BIGINT"


def _permuted(inner: str, x: str, n: str, label: str, out: str) -> str:
    """Nested selects, one per round of the swap-or-not shuffle, over the rows of `inner`."""
    sql = f"SELECT *, {x} AS at0 FROM ({inner})"
    for r in range(_ROUNDS):
        sql = f"SELECT *, md5('mix-1:' || {label} || ':{r}') AS d{r} FROM ({sql})"
        sql = f"SELECT *, {_hex(f'd{r}[13:20]')} % 2147483646 + 1 AS a{r}, {_hex(f'd{r}[21:28]')} % 2147483647 AS b{r} FROM ({sql})"
        sql = f"SELECT *, ((({_hex(f'd{r}[1:12]')} % {n}) - at{r}) % {n} + {n}) % {n} AS m{r} FROM ({sql})"
        sql = f"SELECT *, greatest(at{r}, m{r}) AS h{r} FROM ({sql})"
        sql = (f"SELECT *, (a{r} * (h{r} % 2147483647) + b{r} + h{r} // 2147483647) % 2147483647 AS y{r} FROM ({sql})")
        sql = (f"SELECT *, CASE WHEN ((y{r} * y{r} + b{r}) % 2147483647) // 128 % 2 = 1 THEN m{r} ELSE at{r} END "
               f"AS at{r + 1} FROM ({sql})")
    drop = ", ".join(f"at{r}, d{r}, a{r}, b{r}, m{r}, h{r}, y{r}" for r in range(_ROUNDS))
    return f"SELECT * EXCLUDE ({drop}) RENAME (at{_ROUNDS} AS {out}) FROM ({sql})"


def mix_ctes(docs: str) -> str:
    """CTEs from a table of documents to `mixed`: one row per document."""
    slots = ("SELECT s, first_slot, all_slots, n_blocks, k, k // n_blocks AS pass, "
             "'pass:' || s || ':' || (k // n_blocks) AS label FROM target_of, LATERAL (SELECT unnest(range(slots)) AS k)")
    placed = _permuted(slots, "first_slot + k", "all_slots", "'shards'", "place")
    drawn = _permuted(placed, "k % n_blocks", "n_blocks", "label", "block")
    return f"""
slim AS (SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS s, md5(coalesce(text, '')) AS digest,
  len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM {docs}),
weighed AS (SELECT s, source_size, [5, 2, 1][((row_number() OVER (ORDER BY s)) - 1) % 3 + 1] AS weight
  FROM (SELECT s, sum(size)::BIGINT AS source_size FROM slim GROUP BY s)),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level FROM weighed
  WINDOW before AS (ORDER BY source_size / weight, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (SELECT *, least(2.0::DOUBLE * source_size, max(level) OVER () * weight) AS target,
    ceil(source_size / 128)::BIGINT AS n_blocks FROM levels),
target_of AS (SELECT *, coalesce(sum(slots) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
    AS first_slot, (sum(slots) OVER ())::BIGINT AS all_slots
  FROM (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target * n_blocks / source_size + 0.5)::BIGINT, 2 * n_blocks)
        ELSE 0 END AS slots FROM filled)),
drawn AS ({drawn}),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY s ORDER BY
    md5(coalesce(doc_id::VARCHAR, '') || '|' || digest)[1:3], doc_id NULLS FIRST, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM slim),
piece AS (SELECT s, start, doc_id, size, digest, b AS block,
    least(start + size, (b + 1) * 128) - greatest(start, b * 128) AS n_words, greatest(start, b * 128) - start AS word
  FROM laid, LATERAL (SELECT unnest(range(start // 128, (start + size - 1) // 128 + 1)) AS b) WHERE size > 0),
took AS (SELECT p.s, p.start, p.doc_id, p.size, p.digest, p.word, p.n_words, d.pass, d.place // 4096 AS shard
  FROM piece p JOIN drawn d ON d.s = p.s AND d.block = p.block),
mixed AS (SELECT l.doc_id, l.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken,
    k.first_shard::BIGINT AS first_shard
  FROM laid l JOIN target_of t ON t.s = l.s LEFT JOIN
    (SELECT s, start, sum(n_words) AS taken, min(shard) AS first_shard FROM took GROUP BY s, start) k
    ON k.s = l.s AND k.start = l.start AND l.size > 0)"""


MIX_SQL = f"WITH {mix_ctes('documents')} SELECT * FROM mixed"
