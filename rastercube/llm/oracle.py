"""SQL twins of the corpus queries, where SQL can express them.

op4 and op10 hash and tokenize as SQL cannot, op7, op8 and op9 learn; tests hold these against
brute force or held-out rows.
"""

_HASH = "CAST('0x'||substr(md5('{seed}|'||doc_id),1,15) AS BIGINT)"

_CRC = r"""
crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i,0,0,0,0,0,0,0,0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
checked AS (SELECT d.*, octet_length(encode(coalesce(text,''))) AS n_bytes,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text,''))),'..'), lambda p: CAST('0x'||p AS BIGINT))),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS text_crc32 FROM documents d, crc_table)"""

ORACLE: dict[str, str] = {}

ORACLE["op2_stratified_shards"] = f"""WITH {_CRC},
h AS (SELECT doc_id, source, n_bytes+1 AS size, text_crc32, {_HASH.format(seed=7)} AS h FROM checked),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id)-1 AS r, count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY (CAST(r AS DOUBLE)+CAST({_HASH.replace('doc_id', 'source').format(seed=8)} AS DOUBLE)/1152921504606846976::DOUBLE)/CAST(n AS DOUBLE), source, h, doc_id)-1 AS ord FROM r)
SELECT doc_id, source, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(ord*16//total AS INT) AS shard, ord-((ord*16//total)*total+15)//16 AS slot, CAST(NULL AS INT) AS grown_shard FROM p"""

ORACLE["op1_embedding_hnsw"] = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e,e)) AS n FROM v WHERE list_dot_product(e,e)>0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id<>b.vec_id AND list_dot_product(a.e,b.e)/(a.n*b.n)>=0.95),
c AS (SELECT a, a AS b FROM (SELECT DISTINCT a FROM l) UNION SELECT c.a, l.b FROM c JOIN l ON c.b=l.a),
m AS (SELECT a, min(b) AS component_id FROM c GROUP BY a), d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(d.n,0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id)=vec_id AS kept FROM v LEFT JOIN m ON m.a=vec_id LEFT JOIN d ON d.a=vec_id"""

_CONTROLS = ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<|", "|>")
_ESCAPED = "length(text)+length(text)-length(replace(text,'\\','')) + " + "+".join(f"(length(text)-length(replace(text,'{c}','')))//{len(c)}" for c in _CONTROLS)

ORACLE["op3_chat_fsm"] = f"""WITH t AS (SELECT conv_id, turn, coalesce(role,'') AS role, coalesce(text,'') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role||chr(10)||text||chr(10),'' ORDER BY turn)) AS turns_sha256, CAST(coalesce(sum(length(text)) FILTER (WHERE role='assistant'),0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text,'' ORDER BY turn) FILTER (WHERE role='assistant'),'')) AS loss_sha256,
    CAST(sum({_ESCAPED} + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 END) AS BIGINT) AS formatted_chars,
    regexp_full_match(string_agg(CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END,'' ORDER BY turn),'s?(ua)*u?') AS "valid" FROM t GROUP BY conv_id"""

_WORDS = r"regexp_extract_all(translate(coalesce(text,''),'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op5_wu_manber_decontam"] = f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w),10) AS size, array_to_string(w[i:i+9],' ') AS win FROM (SELECT item, w, unnest(range(1, greatest(len(w)-9,1)+1)) AS i FROM b WHERE len(w)>0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, i, size, array_to_string(w[i:i+size-1],' ') AS win FROM (SELECT doc_id, w, size, unnest(range(1, len(w)-size+2)) AS i FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w)>=size)),
hit AS (SELECT doc_id, i, dw.size, item FROM dw JOIN bw USING(win)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i,i+size)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit,0) AS n_hit, coalesce(n_items,0) AS n_items, sha256(coalesce(items,'')) AS items_sha256, coalesce(n_hit,0)>0 AS contaminated FROM d LEFT JOIN pos USING(doc_id) LEFT JOIN it USING(doc_id)"""

_START = "CAST(e*source_size+before AS BIGINT)"

ORACLE["op6_curriculum_mix"] = rf"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text,''),'[^\x20\x09-\x0D]+')) AS BIGINT) AS size, {_HASH.format(seed=11)} AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST)-1 AS k, count(*) OVER () AS n FROM d GROUP BY source),
q AS (SELECT *, k%3+1 AS w, source_size*3 AS lim, -0.5::DOUBLE+1.0::DOUBLE*k/greatest(n-1,1) AS slope FROM s),
o AS (SELECT *, sum(source_size) OVER () - coalesce(sum(lim) OVER p,0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER p,0) AS lft, row_number() OVER (ORDER BY lim/w::DOUBLE, source NULLS LAST) AS j
    FROM q WINDOW p AS (ORDER BY lim/w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(j) AS j FROM o WHERE rest*w<=lim*lft),
g AS (SELECT o.source, source_size, slope, CASE WHEN o.j<f.j THEN lim::DOUBLE ELSE CAST((SELECT rest FROM o x WHERE x.j=f.j)*w AS DOUBLE)/CAST((SELECT lft FROM o x WHERE x.j=f.j) AS DOUBLE) END AS target FROM o, f),
r AS (SELECT d.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING)-size AS BIGINT) AS before FROM d),
c AS (SELECT doc_id, size, source_size, target, slope, list_filter(list_transform(range(3), lambda e: {_START}), lambda x: size>0 AND 2*x+size<=2*target) AS starts FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source),
e AS (SELECT *, unnest(starts) AS x, generate_subscripts(starts, 1) AS i FROM c),
k AS (SELECT doc_id, i, 2*(x/target)/((1+slope)+sqrt(greatest(0::DOUBLE,(1+slope)*(1+slope)-4*slope*(x/target)))) AS position FROM e),
t AS (SELECT *, row_number() OVER (ORDER BY position, doc_id, i)-1 AS training_rank FROM k)
SELECT doc_id, size, source_size, target, CAST(size*len(starts) AS BIGINT) AS taken, position AS first_position, training_rank FROM c LEFT JOIN (SELECT * FROM t WHERE i=1) USING(doc_id)"""
