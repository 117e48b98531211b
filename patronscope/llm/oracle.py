"""SQL counterparts, for DuckDB."""

#: Words are runs without space, tab, line feed, vertical tab, form feed, carriage return.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
with d as (
  select doc_id, source, coalesce(text, '') t, {WORDS} w, row_number() over () r from documents
), w as (
  select r, generate_series p, w[generate_series : generate_series + 4] g
  from (select r, w, unnest(generate_series(1, len(w) - 4)) generate_series from d where len(w) >= 5)
), rep as (
  select r, p from (select r, p, count(*) over (partition by r, g) n from w) where n > 1
), cov as (
  select r, count(distinct q)::bigint n from (select r, unnest(generate_series(p, p + 4)) q from rep) group by r
), l as (
  select r, count(*) n_lines, count(*) - count(distinct line) dup
  from (select r, unnest(string_split(t, chr(10))) line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by r
), s as (
  select doc_id, source, len(w)::bigint n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::bigint word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols, coalesce(n_lines, 0)::bigint n_lines,
    coalesce(dup, 0)::bigint n_dup_lines, coalesce(cov.n, 0)::bigint n_repeat_words
  from d left join cov using (r) left join l using (r)
), b as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from s
), f as (
  select *, base_failed or n_symbols > 0.1 * n_words or n_dup_lines > 0.3 * n_lines
    or word_chars < 2 * n_words or word_chars > 15 * n_words any_failed,
    base_failed or n_symbols > 0.2 * n_words or n_dup_lines > 0.6 * n_lines or word_chars < 1 * n_words or word_chars > 30 * n_words strong from b
), h as (
  select source, count(*)::double n, sum(any_failed::int)::double x from f where source is not null group by source
), m as (
  select sum(x) / sum(n) mu, sum(x) x, sum(n) n, sum(x * x / n) / sum(n) - (sum(x) / sum(n)) ** 2
    - sum(x) / sum(n) * (1 - sum(x) / sum(n)) * count(*) / sum(n) tau from h
), k as (
  select mu, case when n is null or x = 0 or x = n then 1.0 when tau > mu * (1 - mu) * 1e-6 then greatest(mu * (1 - mu) / tau - 1, 1.0) else 1e6 end strength from m
), v as (
  select source, (x + mu * strength) / (n + strength) > mu + sqrt(mu * (1 - mu) / (strength + 1)) strict from h, k
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not strong and not (coalesce(strict, false) and any_failed) kept
from f left join v using (source)
"""

WARC = """
with p as (
  select page_id, coalesce(html, '') html, sha256(coalesce(html, '')) payload_digest from pages
), q as (
  select *, strlen(html)::bigint payload_bytes, min(page_id) over (partition by payload_digest) first from p
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id > first then 'revisit' else 'response' end record_type,
  case when payload_bytes >= 100 and page_id > first then first end refers_to
from q
"""
