"""DuckDB SQL text for the oracle checks, generated in Python.

Independent of the Spark code paths: transliteration uses DuckDB's
``strip_accents``, ids use the closed form of the base table, BPE rounds are
an unrolled CTE chain.  Only the fixed values (whitespace class, escape set)
are shared, since they define the semantics.
"""

from __future__ import annotations

from tokenmill.functions.text import WS_CLASS

WS_RUN = f"[{WS_CLASS}]+"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def translit(col: str) -> str:
    expr = col
    for a, b in (("ß", "ss"), ("ẞ", "SS"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE")):
        expr = f"replace({expr}, {q(a)}, {q(b)})"
    return f"regexp_replace(strip_accents({expr}), {q('[^\\x00-\\x7f]')}, '', 'g')"


def clean_reference(col: str) -> str:
    return f"regexp_replace({translit(col)}, {q('[' + WS_CLASS + chr(92) * 2 + ']+')}, '', 'g')"


def clean_collapse(col: str) -> str:
    t = f"regexp_replace({translit(col)}, '[\\n\\t]', '', 'g')"
    t = f"regexp_replace({t}, {q(WS_RUN)}, ' ', 'g')"
    return f"replace({t}, chr(92), '')"


def chars(col: str) -> str:
    return f"regexp_extract_all({col}, '(?s).')"


def char_id(ch: str) -> str:
    return (f"(case when {ch} = chr(10) then 97 "
            f"when unicode({ch}) between 32 and 91 then unicode({ch}) - 29 "
            f"when unicode({ch}) between 93 and 126 then unicode({ch}) - 30 end)")


def char_ids(col: str) -> str:
    return f"list_transform({chars(col)}, lambda ch: {char_id('ch')})"


def ids_str(lst: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda x: cast(x as varchar)), ' ')"


def decode_ids(lst: str) -> str:
    """Text of base-vocabulary ids."""
    return (f"array_to_string(list_transform({lst}, lambda x: case x when 0 then '<PAD>' when 1 then '<SOS>' "
            f"when 2 then '<EOS>' when 97 then chr(10) else chr(cast(x + case when x < 63 then 29 else 30 end as int)) end), '')")


def crawl_log(edges_sql: str, start: int, n_pages: int, sample: int, seed: str, rounds: int) -> str:
    """C1's loop as a chain of CTEs, ending in ``crawl(round, ord, page_id)``;
    rounds after the crawl's end add nothing."""
    ctes = [f"e as materialized ({edges_sql})",
            f"log0 as materialized (select 0::bigint as round, 0::bigint as ord, {start}::bigint as page_id)",
            f"f0 as materialized (select distinct dst as page_id from e where src = {start} and dst <> {start})"]
    for k in range(1, rounds + 1):
        order = f"row_number() over (order by md5(concat_ws(':', {q(seed)}, '{k}', page_id::varchar)), page_id)"
        ctes += [f"s{k} as materialized (select * from (select page_id, {order} as i, (select count(*) from log{k - 1}) as c "
                 f"from f{k - 1}) where i <= least({sample}, {n_pages} - c))",
                 f"log{k} as materialized (select * from log{k - 1} union all "
                 f"select {k}, c + i - 1, page_id from s{k})",
                 f"f{k} as materialized ((select page_id from f{k - 1} union select dst from e where src in "
                 f"(select page_id from s{k})) except select page_id from log{k})"]
    return "with " + ", ".join(ctes) + f", crawl as (select * from log{rounds})"


def frame(ids: str, n: int) -> str:
    return (f"list_concat([1], {ids}, [2], "
            f"list_transform(range({n} - len({ids}) - 1), lambda x: 0))")


# --- BPE ----------------------------------------------------------------------
_ESC_CLASS = r"([#$&()*+\-.?\[\]^{|}~])"


def esc(expr: str) -> str:
    """Q4 escape rule: one backslash before each regex special character."""
    return f"regexp_replace({expr}, {q(_ESC_CLASS)}, {q(chr(92) * 2 + chr(92) + '1')}, 'g')"


def bpe_words(text_sql: str) -> str:
    """A1 over ``text_sql`` (doc_id, text): word, freq, first (struct d, p)."""
    return (f"select word, count(*) as freq, min({{'d': doc_id, 'p': pos}}) as first from "
            f"(select doc_id, unnest(ws) as word, unnest(range(len(ws))) as pos from "
            f"(select doc_id, string_split_regex(text, {q(WS_RUN)}) as ws from ({text_sql}))) "
            f"where word <> '' group by word")


def _pairs(w: str) -> str:
    return (f"select s[i] as l, s[i + 1] as r, freq, "
            f"{{'d': first.d, 'p': first.p, 'i': i}} as f from "
            f"(select s, freq, first, unnest(range(1, len(s))) as i from "
            f"(select string_split(sym, ' ') as s, freq, first from {w}))")


def bpe_ctes(text_sql: str, n_merges: int) -> list[str]:
    """Unrolled rounds: w_k (working words), b_k (winning pair of round k)."""
    ctes = [f"words as materialized ({bpe_words(text_sql)})",
            "w0 as materialized (select array_to_string(regexp_extract_all(word, '(?s).'), ' ') as sym, freq, first "
            "from words where length(word) > 1)"]
    for k in range(n_merges):
        ctes.append(f"b{k} as (select l, r, sum(freq) as c, min(f) as f from ({_pairs(f'w{k}')}) "
                    f"group by l, r order by c desc, f limit 1)")
        if k + 1 < n_merges:
            rep = f"replace(w.sym, b.l || ' ' || b.r, {esc('b.l || b.r')})"
            ctes.append(f"w{k + 1} as (select sym, freq, first from "
                        f"(select {rep} as sym, w.freq, w.first from w{k} w, b{k} b) "
                        f"where contains(sym, ' '))")
    ctes.append("merges as (" + " union all ".join(
        f"select {k} as rank, l, r, c from b{k}" for k in range(n_merges)) + ")")
    return ctes


def bpe_merges(text_sql: str, n_merges: int) -> str:
    return ("with " + ", ".join(bpe_ctes(text_sql, n_merges)) +
            " select cast(rank as bigint) as rank, l, r, l || r as token, cast(c as bigint) as c, "
            "cast(98 + rank as bigint) as id from merges")


def bpe_encode(fit_sql: str, n_merges: int, text_sql: str) -> str:
    """Encode by the lowest-id rule as it stands: for each distinct run, take
    the adjacent concatenation of the lowest id, merge its occurrences left to
    right without overlap (a fold over the tokens; an empty string marks that
    the last token was just merged), and repeat.  Emits doc_id, n_tokens,
    encoded.  For texts with white space: a fold copies its list at each token.
    """
    runs = f"regexp_extract_all(text, {q('[' + WS_CLASS + ']|[^' + WS_CLASS + ']+')})"
    pair = "steps.toks[i] || steps.toks[i + 1]"
    return ("with recursive " + ", ".join(bpe_ctes(fit_sql, n_merges)) + f""",
vocab as materialized (select token, max(id) as id from (select l || r as token, 98 + rank as id from merges
  union all select * from (values ('<PAD>', 0), ('<SOS>', 1), ('<EOS>', 2)) s(token, id)) group by token),
v as materialized (select map(list(token), list(id)) as ids, map(list(id), list(token)) as names from vocab),
texts as materialized (select doc_id, text, {runs} as runs from ({text_sql})),
pos as materialized (select doc_id, unnest(runs) as run, unnest(range(len(runs))) as k from texts),
steps(run, toks, k) as (
  select run, {chars('run')}, 0 from (select distinct run from pos)
  union all
  select run, list_filter(list_reduce(list_transform(toks, lambda t: [t]), lambda acc, x:
    case when acc[-1] = '' then list_append(acc[:-2], x[1])
         when acc[-1] || x[1] = s then list_concat(acc[:-2], [s, ''])
         else list_append(acc, x[1]) end), lambda t: t <> ''), k + 1
  from (select run, steps.toks as toks, k,
               v.names[list_min(list_transform(range(1, len(steps.toks)), lambda i: v.ids[{pair}]))] as s
        from steps, v where len(steps.toks) > 1) where s is not null),
done as (select run, arg_max(toks, k) as toks from steps group by run),
enc as materialized (select run, list_transform(done.toks, lambda t: coalesce(v.ids[t], {char_id('t')})) as ids from done, v)
select t.doc_id, cast(coalesce(n, 0) as bigint) as n_tokens, coalesce(encoded, '') as encoded from texts t left join
  (select doc_id, sum(len(ids)) as n, string_agg({ids_str('ids')}, ' ' order by k) as encoded
   from pos join enc using (run) group by doc_id) a on a.doc_id = t.doc_id""")


def bpe_encode_two_char(fit_sql: str, n_merges: int, text_sql: str) -> str:
    """Encode with merges that are all two single characters (checked in SQL).

    Then the lowest-id rule equals anchored replacement in id order on
    characters wrapped in chr(1) markers.  Emits doc_id, n_tokens, encoded.
    """
    X = "chr(1)"
    s = f"{X} || array_to_string({chars('t.text')}, {X} || {X}) || {X}"
    for k in range(n_merges):
        s = (f"replace({s}, (select {X} || l || {X} || {X} || r || {X} from merges where rank = {k} "
             f"and length(l) = 1 and length(r) = 1), (select {X} || l || r || {X} from merges "
             f"where rank = {k}))")
    body = ("with " + ", ".join(bpe_ctes(fit_sql, n_merges)) +
            f", enc as (select t.doc_id, case when t.text = '' then [] else "
            f"string_split(substr({s}, 2, length({s}) - 2), {X} || {X}) end as toks from ({text_sql}) t), "
            f"ids as (select e.doc_id, k, coalesce((select max(98 + rank) from merges m "
            f"where m.l || m.r = tok), {char_id('tok')}) as id "
            f"from (select doc_id, unnest(toks) as tok, unnest(range(len(toks))) as k from enc) e) "
            f"select t.doc_id, cast(coalesce(n, 0) as bigint) as n_tokens, coalesce(encoded, '') as encoded "
            f"from ({text_sql}) t left join (select doc_id, count(*) as n, "
            f"string_agg(cast(id as varchar), ' ' order by k) as encoded from ids group by doc_id) a "
            f"on a.doc_id = t.doc_id")
    return body
