"""DuckDB SQL for the text queries that SQL can express, over the same tables."""

from __future__ import annotations

from .ball_tree import TOP
from .common import UPPER
from .quality_rules import MIN_WORDS, RULES, STOP_WORDS, SYMBOLS
from .quality_rules import WINDOW as REPEAT_WINDOW
from .url_filter import MIN_GOOD, RHO, RULES as URL_RULES, Z
from .decontam import WINDOW as ITEM_WINDOW
from .merkle import ARITY, FIELDS

_LOWER = f"'{UPPER}', '{UPPER.lower()}'"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _url(of: str, part: int) -> str:
    return rf"coalesce(regexp_extract({of}, '(?s)^.*?://([^/?#]*)([^?#]*)', {part}), '')"


def _level(name: str, members: str) -> str:
    """A one-row table with the prior strength of a level; members hold n, k and m."""
    return f"""{name} as (
 select 1 / least(greatest(case when room > 0 then (spread - noise) / room else {RHO[0]} end, {RHO[0]}), {RHO[1]}) - 1 as s from (
  select coalesce(sum(n * pow(k / n - m, 2)), 0) as spread, coalesce(sum(m * (1 - m)), 0) as noise,
         coalesce(sum(m * (1 - m) * (n - 1)), 0) as room from {members} where n > 0))"""


def _url_rules() -> tuple[str, str]:
    longest = sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = [(f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v) for v, h, p in longest]
    return (" ".join(f"when {f} then '{r}'" for f, r, _ in fits), " ".join(f"when {f} then '{v}'" for f, _, v in fits))


def url_filters() -> str:
    rule, verdict = _url_rules()
    return rf"""
with good as (select doc_id, min(quality) as good from labels group by doc_id),
known as (select translate({_url('url', 1)}, {_LOWER}) as host, good from (select url from pages) left join good
  on doc_id = try_cast(regexp_extract(url, '/([0-9]+)[^0-9/]*/?(?:[?#].*)?$', 1) as bigint)),
hosts as (select host, regexp_extract(host, '([^.]*(?:\.[^.]*)?)$', 1) as dom, regexp_extract(host, '([^.]*)$', 1) as suf,
  cast(count(good) as double) as n, cast(coalesce(sum(good), 0) as double) as k from known group by all),
overall as (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) as m from hosts),
s0 as (select suf, sum(n) as n, sum(k) as k, any_value(m) as m from hosts, overall group by suf),
{_level('p0', 's0')},
s1 as (select suf, (s * m + k) / (s + n) as m from s0, p0),
d0 as (select suf, dom, sum(n) as n, sum(k) as k, any_value(m) as m from hosts join s1 using (suf) group by suf, dom),
{_level('p1', 'd0')},
d1 as (select dom, (s * m + k) / (s + n) as m from d0, p1),
h0 as (select host, n, k, m from hosts join d1 using (dom)),
{_level('p2', 'h0')},
ab as (select host, s * m + k as a, s * (1 - m) + n - k as b from h0, p2),
bound as (select host, a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from ab),
judged as (select page_id, translate({_url('url', 1)}, {_LOWER}) as host, {_url('url', 2)} as path from pages)
select page_id, host, path, case {rule} end as rule,
 case {verdict} when bound >= {MIN_GOOD} then 'allow' else 'block' end as verdict from judged left join bound using (host)"""


def decontamination() -> str:
    def cut(table: str, own: str, length: str) -> str:
        return (f"select {own}, i, {length} as len, array_to_string(w[i:i + {length} - 1], ' ') as win from "
                f"(select *, unnest(range(1, len(w) - {length} + 2)) as i from {table})")
    return rf"""
with d as (select row_number() over () as rid, doc_id, {_ITEM_WORDS} as w from documents),
b as (select item_id, w, least(len(w), {ITEM_WINDOW}) as size from (select item_id, {_ITEM_WORDS} as w from benchmark) where len(w) > 0),
items as (select distinct item_id, len, win from ({cut('b', 'item_id', 'size')})),
sized as (select d.*, size from d, (select distinct size from b) where len(w) >= size),
found as (select f.rid, f.i, f.len, items.item_id from ({cut('sized', 'rid', 'size')}) f join items on f.win = items.win and f.len = items.len),
hit as (select rid, count(distinct word_no) as n_hit from (select rid, unnest(range(i, i + len)) as word_no from found) group by rid),
who as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct rid, cast(item_id as varchar) as item from found where item_id is not null) group by rid)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
 sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (rid) left join who using (rid)"""


def quality_rules() -> str:
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    ok = []
    for over, under, least, most in RULES.values():
        ratio = f"(case when {under} > 0 then {over} / {under} else 0.0 end)"
        ok += [f"{ratio} >= {least}"] * (least is not None) + [f"{ratio} <= {most}"] * (most is not None)
    last = REPEAT_WINDOW - 1
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t, {_WORDS} as w from documents),
win as (select rid, i, array_to_string(w[i:i + {last}], ' ') as win from (select rid, w, unnest(range(1, len(w) - {last} + 1)) as i from d)),
twice as (select rid, i from (select *, count(*) over (partition by rid, win) as c from win) where c > 1),
rep as (select rid, sum(least({REPEAT_WINDOW}, coalesce(nxt - i, {REPEAT_WINDOW}))) as r
  from (select rid, i, lead(i) over (partition by rid order by i) as nxt from twice) group by rid),
l as (select rid, doc_id, t, w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from d),
s as (select rid, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
  length(t) - length(translate(t, '{SYMBOLS}', '')) as n_symbols,
  len(list_filter(w, lambda x: lower(x) in ({stop}))) as n_stop,
  len(list_filter(w, lambda x: regexp_matches(x, '^\P{{Ll}}*\p{{Lu}}\P{{Ll}}*[!?]{{2,}}$'))) as n_shout,
  len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines from l),
a as (select s.*, cast(coalesce(r, 0) as bigint) as n_repeat_words from s left join rep using (rid)),
f as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > 20 * n_words as base_failed from a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
 not base_failed and {' and '.join(ok)} as kept from f"""


_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def ball_tree_search() -> str:
    return rf"""
with d as (select row_number() over () as rid, doc_id, {_TERMS} as w from documents),
held as (select rid, doc_id, w, len(w) as n from d where len(w) > 0),
s as (select count(*) as n_docs, cast(coalesce(sum(n), 0) as bigint) as n_terms from held),
q as (select qid, item_id, unnest(list_distinct(w)) as term from (select row_number() over () as qid, item_id, {_TERMS} as w from benchmark)),
tf as (select rid, term, count(*) as tf from (select rid, unnest(w) as term from held) where term in (select term from q) group by all),
weight as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as weight from (select term, count(*) as df from tf group by term), s),
long as (select rid, doc_id, 100 - 50 + ((50 * n * n_docs) // n_terms) as m from held, s),
scored as (select qid, any_value(item_id) as item_id, rid, any_value(doc_id) as doc_id,
  cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
  from q join tf using (term) join weight using (term) join long using (rid) group by qid, rid),
ranked as (select *, row_number() over (partition by qid order by score desc, doc_id nulls first) as place from scored where score > 0)
select item_id, cast(place as integer) as rank, doc_id, score from ranked where place <= {TOP}"""


def merkle_manifest() -> str:
    def field(c: str) -> str:
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    plain = [field(c) for c in FIELDS]
    lowered = [*plain[:-1], field(f"translate(text, {_LOWER})")]
    # crc32 of the id's digits: one table-free round of eight shifts per character
    bits = "list_reduce(list_prepend(xor(a, b), [cast(1 as bigint), 1, 1, 1, 1, 1, 1, 1]), lambda x, y: xor(x // 2, (x % 2) * 3988292384))"
    digits = "list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))"
    crc = f"xor(list_reduce(list_prepend(cast(4294967295 as bigint), {digits}), lambda a, b: {bits}), 4294967295)"
    up = f"idx // {ARITY}"
    run = f"partition by tree, level, {up} order by idx rows between"

    def siblings(nodes: str) -> str:
        return f"""select tree, level, idx, coalesce(string_agg(digest, '') over ({run} unbounded preceding and 1 preceding), '') as l,
 coalesce(string_agg(digest, '') over ({run} 1 following and unbounded following), '') as r from {nodes} where n > 1"""

    def climb(name: str) -> str:
        return f"""select tree, level + 1, {up}, sha256(string_agg(digest, '' order by idx)), any_value((n + {ARITY - 1}) // {ARITY})
  from {name} where n > 1 group by tree, level, {up}"""

    def walk(name: str, sib: str) -> str:
        return f"""select rid, w.tree, w.level + 1, w.{up}, sha256(l || cur || r), proof || l || r
  from {name} w join {sib} s on w.tree = s.tree and w.level = s.level and w.idx = s.idx"""

    return f"""
with recursive d as (select row_number() over () as rid, * from documents),
leaves as (select rid, doc_id, source, sha256({' || '.join(plain)}) as leaf, case when {crc} % 5 = 0 then sha256({' || '.join(lowered)}) end as changed from d),
sources as (select source, count(*) as n, row_number() over (order by source nulls first) - 1 as tree from leaves group by source),
placed as (select rid, doc_id, leaf, changed, tree, n, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as idx
  from leaves join sources on leaves.source is not distinct from sources.source),
nodes(tree, level, idx, digest, n) as (select tree, 0, idx, leaf, n from placed union all {climb('nodes')}),
subroots as (select tree, digest, level from nodes where n = 1),
tops(tree, level, idx, digest, n) as (select -1, 0, tree, digest, (select count(*) from sources) from subroots union all {climb('tops')}),
inner_siblings as ({siblings('nodes')}), top_siblings as ({siblings('tops')}),
walk1(rid, tree, level, idx, cur, proof) as (select rid, tree, 0, idx, coalesce(changed, leaf), '' from placed union all {walk('walk1', 'inner_siblings')}),
walk2(rid, tree, level, idx, cur, proof) as (
  select rid, -1, 0, w.tree, cur, proof from walk1 w join subroots on w.tree = subroots.tree and w.level = subroots.level union all {walk('walk2', 'top_siblings')}),
ends as (select digest as root, level from tops where n = 1)
select doc_id, leaf, digest as subroot, root, sha256(proof) as proof_sha256, cur as folded_root, cur = root as verified
from placed join subroots on placed.tree = subroots.tree join walk2 on placed.rid = walk2.rid join ends on walk2.level = ends.level"""


ORACLES = {"op1_url_filters": url_filters(), "op6_decontamination": decontamination(), "op7_quality_rules": quality_rules(),
           "op12_ball_tree_search": ball_tree_search(), "op13_merkle_manifest": merkle_manifest()}
