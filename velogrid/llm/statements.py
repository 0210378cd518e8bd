"""DuckDB SQL of the queries that need more than a join: Merkle trees and spelling variants."""

from __future__ import annotations

#: SQL: the table of CRC-32, from its polynomial.
CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)) as t"""


def crc32(of_bytes: str) -> str:
    """SQL: the unsigned CRC-32 of a list of byte values, given a column ``t`` of ``CRC_TABLE``."""
    return f"""xor(list_reduce(list_concat([4294967295], {of_bytes}), lambda s, c: xor(s // 256, t[xor(s, c) % 256 + 1])), 4294967295)"""


def _field(x: str) -> str:
    return f"coalesce(strlen(cast({x} as varchar)) || ':' || cast({x} as varchar), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


_UP = "[sha256(l[2 * i - 1] || coalesce(l[2 * i], '')) for i in range(1, (len(l) + 1) // 2 + 1)]"

MERKLE = f"""
with recursive crc as ({CRC_TABLE}),
h as (select *, {crc32("list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ord(c) as bigint))")} % 7 = 0 as hit from documents, crc),
f as (select doc_id, coalesce('=' || lang, '') as grp, {_leaf("n_chars")} as leaf, {_leaf("case when hit then n_chars + 1 else n_chars end")} as changed from h),
p as (select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as pos from f),
lv as (select grp, 0 as d, list(leaf order by pos) as l from p group by grp
  union all select grp, d + 1, {_UP} from lv where len(l) > 1),
sub as (select grp, l[1] as subroot, row_number() over (order by grp) - 1 as pos from lv where len(l) = 1),
tp as (select 0 as d, list(subroot order by pos) as l from sub
  union all select d + 1, {_UP} from tp where len(l) > 1),
up as (select p.doc_id, p.grp, p.pos, d, l[xor(p.pos // cast(power(2, d) as bigint), 1) + 1] as sib, p.pos // cast(power(2, d) as bigint) % 2 as side
    from p join lv on p.grp = lv.grp and len(l) > 1
  union all select p.doc_id, p.grp, p.pos, 1000 + d, l[xor(s.pos // cast(power(2, d) as bigint), 1) + 1], s.pos // cast(power(2, d) as bigint) % 2
    from p join sub s on p.grp = s.grp join tp on len(l) > 1),
way as (select grp, pos, list({{'h': coalesce(sib, ''), 's': side}} order by d) as steps from up group by grp, pos),
done as (select p.doc_id, p.leaf, s.subroot, (select l[1] from tp where len(l) = 1) as root,
    sha256(coalesce(array_to_string(list_transform(steps, lambda x: x.h), ''), '')) as proof_sha256,
    list_reduce(list_concat([{{'h': changed, 's': 0}}], coalesce(steps, [])),
      lambda a, x: {{'h': sha256(case when x.s = 1 then x.h || a.h else a.h || x.h end), 's': 0}}).h as folded_root
  from p join sub s on p.grp = s.grp left join way w on w.grp = p.grp and w.pos = p.pos)
select *, folded_root = root as verified from done
"""

_BYTES = """flatten(list_transform(string_split(k, ''), lambda c: case when unicode(c) < 128 then [cast(unicode(c) as bigint)]
    else [cast(192 + unicode(c) // 64 as bigint), cast(128 + unicode(c) % 64 as bigint)] end))"""

SPELLING = f"""
with recursive crc as ({CRC_TABLE}),
r as (select coalesce(cast(doc_id as varchar), '') as id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) as w from documents),
g as (select id || ':' || w as k, w, count(*) as m from r where length(w) >= 5 group by all),
h as (select w, m, {crc32(_BYTES)} as h from g, crc),
t as (select case when h % 97 = 0 then left(w, h % length(w)) || substr(w, h % length(w) + 2) else w end as word, m from h),
v as (select word, cast(sum(m) as bigint) as n from t where length(word) >= 5 group by word having sum(m) >= 3),
d as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
shorter as (select distinct a.word as a, a.n as an, b.word as b, b.n as bn from d a join v b on a.rest = b.word),
e as (select a.word, b.word as other, b.n as other_n from d a join d b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union all select a, b, bn from shorter union all select b, a, an from shorter),
o as (select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by other_n desc, other) as k from e),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when other_n >= 2 * v.n then other end as form, case when other_n >= 2 * v.n then other_n end as form_n
  from v left join o on o.word = v.word and o.k = 1),
way as (select word, word as at, form as next from f union all select way.word, f.word, f.form from way join f on f.word = way.next)
select f.*, way.at as root from f join way on way.word = f.word and way.next is null
"""
