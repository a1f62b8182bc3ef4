"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from relata.llm import bpe, chosen_path, decontaminate, divergence, html_text, line_dedup, line_labels, merkle, nbsvm, pii, reply_trees, simhash, url_filter
from relata.llm.catalog_files import tokenizer_file
from relata.llm.frames import stored, table


def op1_skip_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents: pattern spans, and what the skip-chain field adds."""
    docs = table(spark, folder, "documents")
    return pii.find(docs, pii.train(docs))


def op2_containment(spark: SparkSession, folder: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item."""
    return decontaminate.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_line_field(spark: SparkSession, folder: str) -> DataFrame:
    """Quality rules on all documents: counts, and the share of words in lines that the field marks as content."""
    docs = table(spark, folder, "documents")
    return line_labels.judge(docs, line_labels.train(docs, table(spark, folder, "labels")))


#: The rules of the query: host and path to verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op4_url_ratio(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on all pages by rules and by the language models of the URLs that these decide."""
    return url_filter.verdicts(table(spark, folder, "pages"), URL_RULES)


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op6_boosted_dom(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of all pages."""
    pages = table(spark, folder, "pages")
    return html_text.extract(pages, html_text.train(pages))


def op7_nbsvm(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents, learnt from the labels that are not held out."""
    docs = table(spark, folder, "documents")
    scored = nbsvm.score(docs, nbsvm.train(docs, table(spark, folder, "labels")))
    predicted = (F.col("score") >= nbsvm.THRESHOLD).cast("int")
    return scored.select("doc_id", nbsvm.held_out("doc_id").alias("held_out"), "score", predicted.alias("predicted"))


def op8_reply_trees(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = [(-7, turn, role, "</s>[INST] ok [/INST]") for turn, role in enumerate(("user", "assistant"))]
    rows = given.unionByName(spark.createDataFrame(tricky, "conv_id long, turn long, role string, text string"))
    written = stored(reply_trees.conversations(reply_trees.branches(reply_trees.chain(rows))), "conversations")
    return reply_trees.digests(written, "tree").withColumnRenamed("tree", "conv_id")


def op9_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without the line runs that occur earlier."""
    return line_dedup.remove_repeats(table(spark, folder, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents and what they decode to, as digests."""
    path = tokenizer_file()
    return bpe.decode(bpe.encode(table(spark, folder, "documents"), path), path, with_digests=True)


def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How the sources of each language differ in their terms, over all documents."""
    return divergence.audit(table(spark, folder, "documents"))


def op12_chosen_path(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of near copies of all documents."""
    return chosen_path.near_copies(table(spark, folder, "documents"))


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, and which rows of a copy without some line ends still lead to its root."""
    docs = table(spark, folder, "documents")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    fields = [F.translate("text", "\n", "") if name == "text" else F.col(name) for name in merkle.FIELDS]
    found = merkle.manifest(docs, F.when(changed, merkle.leaf(*fields)))
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest().alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    """All documents through the stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    "pipeline": pipeline,
    "op1_skip_chain": op1_skip_chain,
    "op2_containment": op2_containment,
    "op3_line_field": op3_line_field,
    "op4_url_ratio": op4_url_ratio,
    "op5_simhash": op5_simhash,
    "op6_boosted_dom": op6_boosted_dom,
    "op7_nbsvm": op7_nbsvm,
    "op8_reply_trees": op8_reply_trees,
    "op9_winnowing": op9_winnowing,
    "op10_bpe": op10_bpe,
    "op11_divergence": op11_divergence,
    "op12_chosen_path": op12_chosen_path,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    "op2_containment": """
with texts as (
  select 'd' side, doc_id id, text from documents union all select 'i', item_id, text from benchmark
), words as (
  select side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z0-9\\x{80}-\\x{10FFFF}]+') w from texts
), shingles as (
  select distinct side, id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s
  from words where len(w) > 0
), items as (select id, s, count(*) over (partition by id) n from shingles where side = 'i')
select d.id doc_id, i.id item_id, count(*) n_shared, any_value(i.n) n_shingles, count(*) / any_value(i.n) containment
from shingles d join items i using (s) where d.side = 'd'
group by d.id, i.id having count(*) >= ceil(any_value(i.n) * 4 / 5)
""",
    "op8_reply_trees": """
with rows as (
  select conv_id, turn, coalesce(role, '') as who, coalesce(text, '') as said from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(who || chr(10) || said || chr(10), '' order by turn nulls first, who, said)) as turns_sha256,
  sum(case when who = 'assistant' then length(said) else 0 end)::bigint as loss_chars,
  sha256(coalesce(string_agg(said, '' order by turn nulls first, who, said) filter (who = 'assistant'), '')) as loss_sha256,
  sum(length(replace(replace(replace(who || said, '&', '&amp;'), '<', '&lt;'), '[', '&lb;')) + length('<s>[INST][/INST]</s>'))::bigint
    as formatted_chars
from rows group by conv_id
""",
    "op11_divergence": """
with docs as (
  select row_number() over () as doc, coalesce(lang, '') lang, coalesce(source, '') source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') words
  from documents
), tokens as (select doc, lang, source, unnest(words) term from docs
), kept as (select lang, term, count(*) n_lang from tokens group by all having count(distinct doc) >= 30
), langs as (select lang, count(*) v, sum(n_lang) n_all from kept group by lang
), groups as (select distinct lang, source from docs
), counts as (select lang, source, term, count(*) c from tokens semi join kept using (lang, term) group by all
), dense as (
  select g.lang, g.source, k.term, coalesce(c.c, 0) c, k.n_lang, l.v, l.n_all, sum(coalesce(c.c, 0)) over (partition by g.lang, g.source) n
  from groups g join kept k using (lang) join langs l using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term
), rates as (
  select lang, source, term, c, 1 + 1000000000::hugeint * (c + 5) // (n + 5 * v) p, 1 + 1000000000::hugeint * (n_lang + 5) // (n_all + 5 * v) q from dense
), pairs as (
  select a.lang, a.source, b.source item, sum(abs(a.p - b.p)) as value
  from rates a join rates b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
  union all
  select a.lang, a.source, b.source, 0 from groups a join groups b on a.lang = b.lang and a.source <> b.source
  where a.lang not in (select lang from langs)
), parts as (
  select lang, source, 'pair' part, item, value from pairs
  union all select lang, source, 'term', term, p - q from rates where c > 0 and p > q
), ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as place from parts)
select lang, source, part, item, value::bigint as value, place::int as rank from ranked where part = 'pair' or place <= 50
""",
    "op12_chosen_path": """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') w from documents
), shingles as (
  select distinct doc_id, unnest(case when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) s
  from words where len(w) > 0
), sizes as (select doc_id, count(*) n from shingles group by doc_id
), shared as (
  select a.doc_id x, b.doc_id y, count(*) common from shingles a join shingles b using (s) where a.doc_id <> b.doc_id group by all
), links as (
  select x, y from shared join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * common >= 85 * (p.n + q.n - common)
), reached as (
  select doc_id x, doc_id y from documents union select r.x, l.y from reached r join links l on r.y = l.x
), least as (select x, min(y) as component_id from reached group by x)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from documents left join sizes using (doc_id) join least on x = doc_id
""",
    "op13_merkle": """
with recursive docs as (
  select *, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(doc_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, 3988292384 * (a & 1)) end) & 1 = 1 changed,
    row_number() over (partition by source order by doc_id nulls first) - 1 place, count(*) over (partition by source) width,
    coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') fields
  from documents
), leaves as (
  select doc_id, source, place, width, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) leaf,
    case when changed then sha256(fields || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
      else sha256(fields || coalesce(strlen(text) || ':' || text, '-')) end checked
  from docs
), nodes as (
  select 0 as level, source, place, width, leaf as digest from leaves
  union all
  select any_value(level) + 1, source, place // 3, (any_value(width) + 2) // 3, sha256(string_agg(digest, '' order by place))
  from nodes where width > 1 group by source, place // 3
), subroots as (
  select source, digest, row_number() over (order by source nulls first) - 1 place, count(*) over () width from nodes where width = 1
), uppers as (
  select 0 as level, place, width, digest from subroots
  union all
  select any_value(level) + 1, place // 3, (any_value(width) + 2) // 3, sha256(string_agg(digest, '' order by place))
  from uppers where width > 1 group by place // 3
), steps as (
  select 0 as upper, n.level, n.source, n.place, coalesce(string_agg(o.digest, '' order by o.place) filter (o.place < n.place), '') l,
    coalesce(string_agg(o.digest, '' order by o.place) filter (o.place > n.place), '') r
  from nodes n join nodes o on n.level = o.level and n.source is not distinct from o.source and n.place // 3 = o.place // 3
  where n.width > 1 group by all
), upper_steps as (
  select n.level, n.place, coalesce(string_agg(o.digest, '' order by o.place) filter (o.place < n.place), '') l,
    coalesce(string_agg(o.digest, '' order by o.place) filter (o.place > n.place), '') r
  from uppers n join uppers o on n.level = o.level and n.place // 3 = o.place // 3 where n.width > 1 group by all
), folds as (
  select source, place leaf_place, 0 as level, place, checked as digest, '' as proof from leaves
  union all
  select f.source, f.leaf_place, f.level + 1, f.place // 3, sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
  from folds f join steps s on s.level = f.level and s.source is not distinct from f.source and s.place = f.place
), ends as (
  select f.source, f.leaf_place, s.place, s.digest subroot, f.digest, f.proof
  from folds f join subroots s on s.source is not distinct from f.source
  qualify f.level = max(f.level) over (partition by f.source, f.leaf_place)
), upper_folds as (
  select source, leaf_place, subroot, 0 as level, place, digest, proof from ends
  union all
  select f.source, f.leaf_place, f.subroot, f.level + 1, f.place // 3, sha256(s.l || f.digest || s.r), f.proof || s.l || s.r
  from upper_folds f join upper_steps s on s.level = f.level and s.place = f.place
), whole as (
  select *, (select digest from uppers where width = 1) root from upper_folds
  qualify level = max(level) over (partition by source, leaf_place)
)
select v.doc_id, v.leaf, w.subroot, w.root, sha256(w.proof) proof_sha256, w.digest folded_root, w.digest = w.root verified
from leaves v join whole w on v.source is not distinct from w.source and v.place = w.leaf_place
""",
}
