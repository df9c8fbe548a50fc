"""Model-input preparation keys: splits, subsamples, chat rendering, tokens, metrics, media
manifests, retrieval-augmented samples, curriculum (SURVEY §2.4-2.9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from labelgraph import constants as K
from labelgraph.functions import chat as C
from labelgraph.functions.text import WS_CLASS, ws_tokens
from labelgraph.operators import growing_split as G
from labelgraph.operators import media as M
from labelgraph.operators import ontology as O
from labelgraph.operators import predictions as P
from labelgraph.operators import qa as Q
from labelgraph.operators import raft as R
from labelgraph.operators import samples as S
from labelgraph.operators import splits as SP
from labelgraph.operators import tokens as T
from labelgraph.plans.fixtures import fixture, register_tables
from labelgraph.plans.q_samples import CHECK_CTES, entries, images
from labelgraph.plans.q_ontology import _QA_FULL_SQL
from labelgraph.plans.registry import CONCEPT_CTES, ORACLE, query, strip_sql
from labelgraph.session import cut_lineage, scratch_path
from labelgraph.sources.prompt import read_prompt

# the stage-2 system prompt is an input file: the first benchmark text, written as a file and read back
PROMPT_SQL = "(SELECT text || chr(10) FROM benchmark ORDER BY item_id LIMIT 1)"
TRAIN_N = K.TEST_SAMPLES
BATCH = 8
EVERY = 10
SEED = K.DEFAULT_SEED


def docs(spark, sf):
    return register_tables(spark, sf)["documents"]


def prompt(spark, sf):
    path = scratch_path(spark, "prompt")
    first = register_tables(spark, sf)["benchmark"].orderBy("item_id").limit(1)
    first.select("text").coalesce(1).write.text(path)
    return F.lit(read_prompt(spark, path))


def conv(spark, sf):
    return register_tables(spark, sf)["conversations"]


def _b1000(x: str) -> str:
    return f"(('0x' || substr(md5('{SEED}:' || CAST({x} AS VARCHAR)), 1, 8))::BIGINT % 1000)"


def _s48(x: str) -> str:
    return f"('0x' || substr(md5('{SEED}:' || CAST({x} AS VARCHAR)), 1, 12))::BIGINT"


def _h32(*parts: str) -> str:
    body = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"('0x' || substr(md5('{SEED}:' || {body}), 1, 8))::BIGINT"


# ---- splits ------------------------------------------------------------------------------
@query("split_hash", f"SELECT doc_id, CASE WHEN {_b1000('doc_id')} < 100 THEN 'eval' ELSE 'train' END AS split FROM documents")
def split_hash(spark, sf):
    return SP.split_hash(docs(spark, sf), "doc_id", SEED).select("doc_id", "split")


@query("split_grouped", f"SELECT doc_id, source, CASE WHEN {_b1000('source')} < 100 THEN 'eval' ELSE 'train' END AS split FROM documents")
def split_grouped(spark, sf):
    return SP.split_hash(docs(spark, sf), "source", SEED).select("doc_id", "source", "split")


@query(
    "split_exact",
    f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_s48('doc_id')}, doc_id) <= ceil(0.1 * count(*) OVER ())
    THEN 'eval' ELSE 'train' END AS split FROM documents""",
)
def split_exact(spark, sf):
    return SP.split_exact(docs(spark, sf).select("doc_id"), "doc_id", SEED).select("doc_id", "split")


def _first_batch(where: str) -> str:
    return f"""SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_s48('doc_id')}, doc_id) <= ceil(0.1 * count(*) OVER ())
    THEN 'eval' ELSE 'train' END AS split FROM documents WHERE {where}"""


def _grown(spark, sf):
    """The documents stored in two increments, with the cut after each."""
    path, d = scratch_path(spark, "growing-split"), docs(spark, sf).select("doc_id")
    cuts = []
    for batch, part in enumerate((_EARLY, f"not ({_EARLY})")):
        G.append_batch(d.where(part), "doc_id", path, batch, SEED)
        cuts.append(G.find_cut(spark, path))
    return path, cuts


_EARLY = "doc_id % 5 < 3"


@query("split_exact_grown", ORACLE["split_exact"])
def split_exact_grown(spark, sf):
    """Split after two appends, from the stored scores: equal to the split of all rows at once."""
    path, (_, cut) = _grown(spark, sf)
    return G.split_at(spark, path, cut).withColumnRenamed("key", "doc_id")


@query(
    "split_exact_moved",
    f"""WITH old AS ({_first_batch(_EARLY)}), new AS ({_first_batch('TRUE')})
    SELECT doc_id, old.split AS was, new.split AS split FROM old JOIN new USING (doc_id) WHERE old.split <> new.split""",
)
def split_exact_moved(spark, sf):
    """Rows of the first increment that change sides with the second."""
    path, (old, new) = _grown(spark, sf)
    return G.moved(spark, path, old, new).select(F.col("key").alias("doc_id"), "was", "split")


_RANKED = f"""r AS (SELECT doc_id, CASE WHEN {_b1000('doc_id')} < 100 THEN 'eval' ELSE 'train' END AS split,
  row_number() OVER (PARTITION BY CASE WHEN {_b1000('doc_id')} < 100 THEN 'eval' ELSE 'train' END
                     ORDER BY {_s48('doc_id')}, doc_id) AS rn FROM documents)"""


@query("subsample_topn", f"WITH {_RANKED} SELECT doc_id FROM r WHERE split = 'train' AND rn <= {TRAIN_N}")
def subsample_topn(spark, sf):
    d = SP.split_hash(docs(spark, sf).select("doc_id"), "doc_id", SEED).where("split = 'train'")
    return SP.first_n(d, TRAIN_N, [SP.score48("doc_id", seed=SEED), F.col("doc_id")]).select("doc_id")


@query("eval_cap", f"WITH {_RANKED} SELECT doc_id FROM r WHERE split = 'eval' AND rn <= {SP.eval_cap(TRAIN_N)}")
def eval_cap(spark, sf):
    d = SP.split_hash(docs(spark, sf).select("doc_id"), "doc_id", SEED).where("split = 'eval'")
    return SP.first_n(d, SP.eval_cap(TRAIN_N), [SP.score48("doc_id", seed=SEED), F.col("doc_id")]).select("doc_id")


# ---- chat rendering ------------------------------------------------------------------------
def _turn_sql(role: str, content: str, nl: bool = True) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>'" + (" || chr(10)" if nl else "")


_IMG = f"'{K.IMAGE_PLACEHOLDER}'"


@query(
    "chat_render_text",
    f"""SELECT u.conv_id, u.turn, {_turn_sql('user', 'u.text')} || {_turn_sql('assistant', 'a.text', nl=False)} AS text
    FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
    WHERE u.role = 'user' AND a.role = 'assistant'""",
)
def chat_render_text(spark, sf):
    c = conv(spark, sf)
    u = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("instruction"))
    a = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output"))
    return u.join(a, ["conv_id", "turn"]).select("conv_id", "turn", C.two_turn_text("instruction", "output").alias("text"))


@query(
    "chat_render_mm",
    f"""SELECT conv_id, turn, {_turn_sql('system', PROMPT_SQL)} || {_turn_sql('user', _IMG)} || {_turn_sql('assistant', 'text')} AS text
    FROM conversations WHERE role = 'assistant'""",
)
def chat_render_mm(spark, sf):
    a = conv(spark, sf).where("role = 'assistant'")
    return a.select("conv_id", "turn", C.training_layout(prompt(spark, sf), "text").alias("text"))


@query("chat_render_turns", "SELECT conv_id, turn, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS segment FROM conversations")
def chat_render_turns(spark, sf):
    return conv(spark, sf).select("conv_id", "turn", C.turn_segment("role", "text").alias("segment"))


@query(
    "chat_render_infer",
    f"""SELECT conv_id, turn, {_turn_sql('system', "'" + K.DEFAULT_SYSTEM + "'")} || {_turn_sql('user', _IMG + ' || text')}
       || '<|im_start|>assistant' || chr(10) AS text FROM conversations WHERE role = 'user'""",
)
def chat_render_infer(spark, sf):
    u = conv(spark, sf).where("role = 'user'")
    return u.select("conv_id", "turn", C.inference_layout("text").alias("text"))


# ---- tokens --------------------------------------------------------------------------------
_TOK = f"""tk AS (SELECT doc_id, CASE WHEN {strip_sql('text')} = '' THEN []::VARCHAR[]
                ELSE regexp_split_to_array({strip_sql('text')}, '{WS_CLASS}+') END AS tokens FROM documents),
ids AS (SELECT doc_id, len(tokens) AS n_tokens,
   list_transform(tokens, lambda t: (('0x' || substr(md5(t), 1, 8))::BIGINT % {T.VOCAB_SIZE - 1} + 1)::INTEGER) AS ids
   FROM tk),
cut AS (SELECT doc_id, n_tokens, ids[1:{K.MAX_LENGTH}] AS t FROM ids),
padded AS (SELECT doc_id, n_tokens, len(t) AS n_real,
   list_concat(t, list_transform(range({K.MAX_LENGTH} - len(t)), lambda x: 0)) AS input_ids,
   list_concat(list_transform(range(len(t)), lambda x: 1), list_transform(range({K.MAX_LENGTH} - len(t)), lambda x: 0)) AS mask
   FROM cut)"""


def _tokenised(spark, sf, whole: bool = False):
    """Ids of all tokens, or of those that truncation keeps; the others aren't hashed then."""
    d = docs(spark, sf).select("doc_id", ws_tokens("text").alias("tokens"))
    used = F.col("tokens") if whole else F.slice("tokens", 1, K.MAX_LENGTH)
    d = d.select("doc_id", F.size("tokens").alias("n_tokens"), T.hashed_ids(used).alias("ids"))
    input_ids, mask = T.truncate_pad("ids")
    n_real = F.least(F.size("ids"), F.lit(K.MAX_LENGTH))
    return d.select("doc_id", "n_tokens", n_real.alias("n_real"), input_ids.alias("input_ids"), mask.alias("mask"), "ids")


@query(
    "tok_truncate_pad",
    f"WITH {_TOK} SELECT doc_id, CAST(n_tokens AS INTEGER) AS n_tokens, CAST(n_real AS INTEGER) AS n_real, array_to_string(input_ids, ' ') AS input_ids, CAST(list_sum(mask) AS BIGINT) AS mask_sum FROM padded",
)
def tok_truncate_pad(spark, sf):
    t = _tokenised(spark, sf)
    return t.select("doc_id", "n_tokens", "n_real", F.array_join("input_ids", " ").alias("input_ids"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


@query(
    "tok_labels",
    f"""WITH {_TOK} SELECT doc_id,
      array_to_string(list_transform(input_ids, lambda x, i: CASE WHEN mask[i] = 1 THEN x ELSE {K.IGNORE_INDEX} END), ' ') AS labels
    FROM padded""",
)
def tok_labels(spark, sf):
    t = _tokenised(spark, sf)
    return t.select("doc_id", F.array_join(T.causal_labels("input_ids", "mask"), " ").alias("labels"))


@query(
    "tok_batch_pad",
    f"""WITH {_TOK}, b AS (SELECT doc_id, doc_id // {BATCH} AS batch, ids, max(len(ids)) OVER (PARTITION BY doc_id // {BATCH}) AS n FROM ids)
    SELECT doc_id, batch, CAST(n AS INTEGER) AS batch_len,
      array_to_string(list_concat(ids, list_transform(range(n - len(ids)), lambda x: 0)), ' ') AS padded FROM b""",
)
def tok_batch_pad(spark, sf):
    t = _tokenised(spark, sf, whole=True)
    p = T.batch_longest_pad(t, "ids", "doc_id", BATCH, size="n_tokens")
    return p.select("doc_id", "batch", "batch_len", F.array_join("padded", " ").alias("padded"))


_ACC_SQL = """SELECT count(*) FILTER (WHERE label <> -100 AND pred = label) AS n_correct,
  count(*) FILTER (WHERE label <> -100) AS n_total,
  CASE WHEN count(*) FILTER (WHERE label <> -100) > 0 THEN
    count(*) FILTER (WHERE label <> -100 AND pred = label) / count(*) FILTER (WHERE label <> -100) END AS accuracy"""


@query("token_accuracy", f"{_ACC_SQL} FROM fx_tokens", ("fx_tokens",))
def token_accuracy(spark, sf):
    return T.masked_accuracy(fixture(spark, sf, "fx_tokens"))


@query(
    "token_accuracy_shifted",
    f"{_ACC_SQL} FROM (SELECT a.pred, b.label FROM fx_tokens a JOIN fx_tokens b ON a.seq = b.seq AND b.pos = a.pos + 1)",
    ("fx_tokens",),
)
def token_accuracy_shifted(spark, sf):
    return T.masked_accuracy(T.shift_pairs(fixture(spark, sf, "fx_tokens")))


@query("logits_argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax, label FROM embeddings")
def logits_argmax(spark, sf):
    e = register_tables(spark, sf)["embeddings"]
    return e.select("vec_id", T.argmax("embedding").alias("argmax"), "label")


# ---- media -----------------------------------------------------------------------------------
@query(
    "frame_sample",
    f"""SELECT media_id, event_id, frame_no, 'frames/' || media_id || '/frame_' || frame_no || '.jpg' AS path FROM (
      SELECT media_id, event_id, row_number() OVER (PARTITION BY media_id ORDER BY ts, event_id) - 1 AS frame_no FROM fx_frames)
    WHERE frame_no % {EVERY} = 0""",
    ("fx_frames",),
)
def frame_sample(spark, sf):
    f = fixture(spark, sf, "fx_frames")
    return M.frame_sample(f, "media_id", ["ts", "event_id"], every=EVERY).select("media_id", "event_id", "frame_no", "path")


@query(
    "frame_manifest",
    f"""SELECT media_id, frame_no, 'frames/' || media_id || '/frame_' || frame_no || '.jpg' AS path FROM (
      SELECT media_id, unnest(range(0, count(*), {EVERY})) AS frame_no FROM fx_frames GROUP BY media_id)""",
    ("fx_frames",),
)
def frame_manifest(spark, sf):
    counts = fixture(spark, sf, "fx_frames").groupBy("media_id").agg(F.count(F.lit(1)).alias("n_frames"))
    return M.frame_manifest(counts, "media_id", "n_frames", every=EVERY)


@query(
    "page_manifest",
    """SELECT doc_id, CAST(page_no AS INTEGER) AS page_no, 'pages/' || doc_id || '/page_' || page_no || '.png' AS path FROM (
      SELECT doc_id, unnest(range(1, n_pages + 1)) AS page_no FROM fx_pages WHERE n_pages > 0)""",
    ("fx_pages",),
)
def page_manifest(spark, sf):
    return M.page_manifest(fixture(spark, sf, "fx_pages"), "doc_id", "n_pages")


# ---- retrieval-augmented samples --------------------------------------------------------------
_RAFT = f"""WITH src_entries AS (SELECT meta_path, pos, entry FROM fx_entries), {CHECK_CTES},
{CONCEPT_CTES},
rdefs AS (SELECT name AS term, min(text) AS definition FROM ctext WHERE length(text) > 0 GROUP BY name),
idx AS (SELECT term, definition, row_number() OVER (ORDER BY term) - 1 AS idx FROM rdefs),
cc AS (SELECT count(*) AS c FROM rdefs),
lj AS (SELECT meta_path || '#' || pos AS sample, labels_json, from_json(labels_json, '{{"Areas":["VARCHAR"],"Scopes":["VARCHAR"],"Abilities":["VARCHAR"]}}') AS l
       FROM accepted WHERE starts_with(labels_json, '{{')),
lab AS (
  SELECT sample, 'Area' AS dim, unnest(l.Areas) AS term FROM lj
  UNION ALL SELECT sample, 'Scope', unnest(l.Scopes) FROM lj
  UNION ALL SELECT sample, 'Ability', unnest(l.Abilities) FROM lj),
per AS (SELECT sample, count(DISTINCT term) AS n_labels FROM lab WHERE term IS NOT NULL GROUP BY sample),
p1 AS (SELECT c, CAST({K.STRIDE_PRIME} % c AS HUGEINT) AS s1 FROM cc),
p3 AS (SELECT c, s1, (s1 * s1) % c AS s2, ((s1 * s1) % c * s1) % c AS s3 FROM p1),
strides AS (SELECT c, CAST([s1, s2, s3, (s3 * s1) % c] AS BIGINT[]) AS s FROM p3),
draws AS (SELECT p.sample, {_h32('p.sample')} % cc.c AS b,
   list_extract(cc.s, ({_h32("'stride'", 'p.sample')} % {K.STRIDES} + 1)::INTEGER) AS a,
   cc.c AS c, unnest(range(least(cc.c, p.n_labels + 3))) AS j FROM per p, strides cc),
cand AS (SELECT d.sample, d.j, i.term, i.definition FROM draws d JOIN idx i ON (d.b + d.j * d.a) % d.c = i.idx
   WHERE NOT EXISTS (SELECT 1 FROM lab l WHERE l.sample = d.sample AND l.term = i.term)),
distract AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY j) AS r FROM cand) WHERE r <= 3)
"""


def _raft_inputs(spark, sf):
    acc, _ = S.accept_and_reject(entries(spark, sf), images(spark, sf))
    acc = cut_lineage(acc.where(F.startswith("labels_json", F.lit("{"))).select("meta_path", "pos", "labels_json"), "raft-accepted")
    schema = "struct<Areas: array<string>, Scopes: array<string>, Abilities: array<string>>"
    lj = acc.select(F.concat_ws("#", "meta_path", "pos").alias("sample"), F.from_json("labels_json", schema).alias("l"), F.col("labels_json").alias("answer"))
    labels = P.long_form(lj, "sample", {d: F.col("l")[key] for d, key in zip(K.DIM_NAMES, K.LABEL_KEYS)})
    t = fixture(spark, sf, "fx_triples")
    ct = O.concept_text(t, O.Vocab.bare()).where(F.length("text") > 0)
    defs = ct.groupBy(F.col("name").alias("term")).agg(F.min("text").alias("definition"))
    return labels, defs, lj.select("sample", "answer")


@query("raft_oracle", _RAFT + "SELECT DISTINCT l.sample, l.dim, l.term, d.definition FROM lab l JOIN rdefs d ON l.term = d.term",
       ("fx_entries", "fx_images", "fx_triples"))
def raft_oracle(spark, sf):
    labels, defs, _ = _raft_inputs(spark, sf)
    return R.oracle(labels, defs).distinct()


@query("raft_distractors", _RAFT + "SELECT sample, j, term FROM distract", ("fx_entries", "fx_images", "fx_triples"))
def raft_distractors(spark, sf):
    labels, defs, _ = _raft_inputs(spark, sf)
    return R.distractors(labels, defs, k=3, seed=SEED).select("sample", "j", "term")


@query(
    "raft_samples",
    _RAFT
    + f""", docs AS (
      SELECT DISTINCT l.sample, l.term, d.definition, TRUE AS is_oracle FROM lab l JOIN rdefs d ON l.term = d.term
      UNION ALL SELECT sample, term, definition, FALSE FROM distract),
    d2 AS (SELECT sample, term, min(definition) AS definition, bool_or(is_oracle) AS is_oracle FROM docs GROUP BY sample, term),
    per_s AS (SELECT sample, count(*) AS n_docs, count(*) FILTER (WHERE is_oracle) AS n_oracle,
            string_agg(definition, chr(10) || chr(10) ORDER BY {_h32('sample', 'term')}, term) AS context FROM d2 GROUP BY sample)
    SELECT per_s.sample, n_docs, n_oracle, context, lj.labels_json AS answer FROM per_s JOIN lj ON per_s.sample = lj.sample""",
    ("fx_entries", "fx_images", "fx_triples"),
)
def raft_samples(spark, sf):
    labels, defs, answers = _raft_inputs(spark, sf)
    return R.samples(labels, defs, answers, k=3, seed=SEED)


# ---- curriculum and stage-2 dataset -----------------------------------------------------------------
_SYS = _turn_sql("system", PROMPT_SQL)


@query(
    "curriculum",
    _QA_FULL_SQL
    + f""", src_entries AS (SELECT meta_path, pos, entry FROM fx_entries), {CHECK_CTES}
    SELECT 1 AS stage, part || '|' || key AS key, {_turn_sql('user', 'instruction')} || {_turn_sql('assistant', 'output', nl=False)} AS text FROM qa_full
    UNION ALL
    SELECT 2, id, {_SYS} || {_turn_sql('user', _IMG)} || {_turn_sql('assistant', 'labels_json')} FROM samples""",
    ("fx_triples", "fx_entries", "fx_images"),
)
def curriculum(spark, sf):
    qa = Q.qa_full(fixture(spark, sf, "fx_triples"), O.Vocab.bare())
    s1 = qa.select(F.concat_ws("|", "part", "key").alias("key"), C.two_turn_text("instruction", "output").alias("text"))
    smp = S.training_samples(entries(spark, sf), images(spark, sf))
    s2 = smp.select(F.col("id").alias("key"), C.training_layout(prompt(spark, sf), smp.conversations[1]["value"]).alias("text"))
    return SP.curriculum(s1, s2)


@query(
    "chat_dataset",
    f"""WITH src_entries AS (SELECT meta_path, pos, entry FROM fx_entries), {CHECK_CTES},
    sp AS (SELECT id, image, labels_json, CASE WHEN {_b1000('id')} < 100 THEN 'eval' ELSE 'train' END AS split FROM samples)
    SELECT id, image, split, {_SYS} || {_turn_sql('user', _IMG)} || {_turn_sql('assistant', 'labels_json')} AS text FROM sp""",
    ("fx_entries", "fx_images"),
)
def chat_dataset(spark, sf):
    smp = S.training_samples(entries(spark, sf), images(spark, sf))
    smp = SP.split_hash(smp.select("id", "image", smp.conversations[1]["value"].alias("answer")), "id", SEED)
    return smp.select("id", "image", "split", C.training_layout(prompt(spark, sf), "answer").alias("text"))


_TURN_TEXT = "'<|im_start|>' || CASE t.\"from\" WHEN 'human' THEN 'user' ELSE 'assistant' END || chr(10) || t.value || '<|im_end|>' || chr(10)"


@query(
    "chat_render_array",
    f"""WITH src_entries AS (SELECT meta_path, pos, entry FROM fx_entries), {CHECK_CTES}
    SELECT id, array_to_string(list_transform(conversations, lambda t: {_TURN_TEXT}), '') AS text FROM samples""",
    ("fx_entries", "fx_images"),
)
def chat_render_array(spark, sf):
    smp = S.training_samples(entries(spark, sf), images(spark, sf))
    return smp.select("id", C.render_turns("conversations").alias("text"))

