"""Nested records. Nested inputs are built from table rows, one record per row."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import nested as V
from lakeops.operators.aggregates import duplicates
from lakeops.queries.registry import query, text
from lakeops.queries.relational import n_rows

c, lit = F.col, F.lit


def signals(t):
    """Events as webhook payloads."""
    member = F.struct(
        F.when(c("event_type") == "click", F.concat(lit("User "), c("user_id"))).alias("fullName"),
        lit("First").alias("firstName"), c("user_id").cast("string").alias("lastName"),
        F.struct(F.when(c("event_type") == "view", c("event_id").cast("string")).alias("salesforceAccountId")).alias("organization"),
    )
    payload = F.struct(member.alias("member"), F.when(c("event_type") == "error", lit("acc")).alias("salesforceAccountId"), c("value").alias("score"))
    return t.events.select("event_id", F.to_json(F.struct(payload.alias("payload"))).alias("body"))


@query("v1_json_paths", """
select event_id, case event_type when 'error' then 'acc' when 'view' then cast(event_id as varchar) end as account_id,
  case when event_type = 'click' then 'User ' || user_id else 'First ' || user_id end as member_name, cast(floor(value) as bigint) as score from events""")
def _(t):
    body = c("body")
    name = F.coalesce(
        V.json_path(body, "payload:member:fullName"),
        F.concat(V.json_path(body, "payload:member:firstName"), lit(" "), V.json_path(body, "payload:member:lastName")),
    )
    return signals(t).select(
        "event_id",
        V.json_path(body, "payload:salesforceAccountId", "payload:member:organization:salesforceAccountId").alias("account_id"),
        name.alias("member_name"), F.floor(V.json_path(body, "payload:score", dtype="double")).alias("score"),
    )


@query("v2_typed_columns", "select event_id, cast(json_extract_string(props, '$.k') as bigint) as k, null::varchar as missing from events")
def _(t):
    return V.typed_columns(t.events, "props", {"k": "bigint", "missing": "string"}, ["event_id"])


def transcripts(t):
    """Turns as transcripts: one sentence per line of text."""
    sentence = lambda text_line, i: F.struct(c("role").alias("speaker_id"), (i * 1000).alias("start_ms"), text_line.alias("text"))
    return t.conversations.select("conv_id", "turn", F.transform(F.split("text", "\n"), sentence).alias("sentences"))


_LINES_SQL = "(select conv_id, turn, role, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as i from conversations)"


@query("v3_flatten_array", f"select conv_id, turn, role as speaker_id, cast(i * 1000 as integer) as start_ms, md5(line) as sentence from {_LINES_SQL}")
def _(t):
    fields = {"speaker_id": c("e.speaker_id"), "start_ms": c("e.start_ms"), "sentence": F.md5("e.text")}
    return V.flatten_array(transcripts(t), "sentences", fields, ["conv_id", "turn"])


@query("v4_field_of_every", "select conv_id, turn, md5(replace(text, chr(10), '|')) as lines from conversations")
def _(t):
    body = F.to_json(F.struct(F.struct(c("sentences").alias("items")).alias("data")))
    lines = V.json_field_of_every(c("body"), "data.items", "text")
    return transcripts(t).select("conv_id", "turn", body.alias("body")).select("conv_id", "turn", F.md5(F.array_join(lines, "|")).alias("lines"))


@query("v5_object_or_empty", """
select event_id, case when event_type in ('click', 'purchase') then cast(json_extract_string(props, '$.k') as bigint) end as k, event_type not in ('click', 'purchase') as is_empty from events""")
def _(t):
    kind = c("event_type")
    raw = F.when(kind == "error", lit("{broken")).when(kind == "view", lit("[1, 2]")).when(kind.isin("click", "purchase"), c("props"))
    rows = t.events.select("event_id", V.object_or_empty(raw).alias("body"))
    return rows.select("event_id", V.json_path(c("body"), "k", dtype="bigint").alias("k"), (c("body") == "{}").alias("is_empty"))


def usage_pages(t):
    """Orders as saved pages: one bucket with a result per price class, and an empty bucket."""
    result = lambda model, share: F.struct(
        lit(model).alias("model"), F.floor(c("o_totalprice") * share).alias("output_tokens"),
        F.struct(F.when(c("o_orderstatus") == "F", c("o_custkey")).alias("ephemeral_5m_input_tokens")).alias("cache_creation"),
    )
    at = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    results = F.when(c("o_orderpriority") != "5-LOW", F.array(result("large", 0.5), result("small", 0.25)))
    bucket = F.struct(at.alias("starting_at"), at.alias("ending_at"), F.coalesce(results, F.filter(results, lambda r: lit(False))).alias("results"))
    return t.orders.select(F.array(bucket).alias("data"), lit(False).alias("has_more"))


_USAGE_SQL = """(select strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') as starting_at, model, cast(floor(o_totalprice * share) as bigint) as output_tokens,
  case when o_orderstatus = 'F' then o_custkey else 0 end as cached from orders, (values ('large', 0.5), ('small', 0.25)) m(model, share) where o_orderpriority <> '5-LOW')"""


@query("s25_page_rows", "select count(*) as buckets, count(*) filter (o_orderpriority <> '5-LOW') as filled from orders")
def _(t):
    from lakeops.sources.files import page_rows

    return page_rows(usage_pages(t)).agg(n_rows("buckets"), F.count_if(F.size("results") > 0).alias("filled"))


@query("v6_bucket_rows", f"select starting_at, model, count(*) as n, cast(sum(output_tokens) as bigint) as output_tokens from {_USAGE_SQL} group by 1, 2")
def _(t):
    rows = V.usage_rows(usage_pages(t))
    return rows.groupBy("starting_at", "model").agg(n_rows("n"), F.sum("output_tokens").alias("output_tokens"))


@query("v7_nested_defaults", f"select model, cached as cache_creation_ephemeral_5m_input_tokens, count(*) as n from {_USAGE_SQL} group by 1, 2")
def _(t):
    rows = V.usage_rows(usage_pages(t)).select("model", *V.value_or_zero("cache_creation.ephemeral_5m_input_tokens"))
    return rows.groupBy("model", "cache_creation_ephemeral_5m_input_tokens").agg(n_rows("n"))


@query("v8_actor_split", """
select event_id, case when event_type = 'click' then 'u' || user_id end as actor_email, case when event_type = 'view' then 'key' || user_id end as actor_api_key_name from events""")
def _(t):
    actor = F.struct(
        F.when(c("event_type") == "click", "user_actor").when(c("event_type") == "view", "api_actor").alias("type"),
        F.concat(lit("u"), c("user_id")).alias("email_address"), F.concat(lit("key"), c("user_id")).alias("api_key_name"),
    )
    rows = t.events.select("event_id", actor.alias("actor"))
    return rows.select(
        "event_id", V.only_for(c("actor.type"), "user_actor", c("actor.email_address")).alias("actor_email"),
        V.only_for(c("actor.type"), "api_actor", c("actor.api_key_name")).alias("actor_api_key_name"),
    )


@query("v9_outer_explode", "select conv_id, turn, unnest([role, 'any']) as model from conversations where role <> 'system' union all select conv_id, turn, null from conversations where role = 'system'")
def _(t):
    models = F.when(c("role") != "system", F.array(F.struct(c("role").alias("model")), F.struct(lit("any").alias("model"))))
    return V.flatten_array(t.conversations.withColumn("models", models), "models", {"model": c("e.model")}, ["conv_id", "turn"], outer=True)


@query("v10_list_or_single", """
select o_orderkey, 'a' as product_name, cast(floor(o_totalprice) as bigint) as cost from orders where o_orderstatus <> 'P'
union all select o_orderkey, 'b', o_custkey from orders where o_orderstatus = 'F'""")
def _(t):
    first = F.struct(lit("a").alias("product_name"), F.floor("o_totalprice").alias("cost"))
    second = F.struct(lit("b").alias("product_name"), c("o_custkey").alias("cost"))
    body = F.when(c("o_orderstatus") == "O", F.to_json(first)).when(
        c("o_orderstatus") == "F", F.concat(lit("["), F.to_json(first), lit(",7,"), F.to_json(second), lit("]"))
    ).otherwise("[]")
    charges = V.one_or_many(body, "product_name string, cost bigint")
    return t.orders.select("o_orderkey", F.explode(charges).alias("x")).select("o_orderkey", "x.*")


def crm_objects(t):
    """Customers as CRM objects with properties, their history, and associations."""
    entry = lambda value, at: F.struct(value.alias("value"), lit(at).alias("timestamp"))
    history = F.create_map(
        lit("segment"), F.array(entry(c("c_mktsegment"), "2024-01-02"), entry(lit("NEW"), "2024-01-01")),
        lit("balance"), F.array(entry(c("c_acctbal").cast("string"), "2024-01-03")),
        lit("empty"), F.filter(F.array(entry(lit(""), "")), lambda e: lit(False)),
    )
    pair = F.struct(c("c_nationkey").alias("id"))
    return t.customer.select(
        F.concat(lit("obj"), c("c_custkey")).alias("id"), c("c_custkey").alias("hs_object_id"),
        F.create_map(lit("name"), c("c_name"), lit("segment"), c("c_mktsegment")).alias("properties"),
        F.when(c("c_acctbal") > 0, history).alias("propertiesWithHistory"),
        F.create_map(lit("companies"), F.struct(F.array(pair, pair, F.struct(lit(-1).alias("id"))).alias("results"))).alias("associations"),
    )


@query("v11_property_history", """
select 'obj' || c_custkey as object_id, property_name, value, "timestamp" from customer, lateral (select * from (values
  ('segment', c_mktsegment, '2024-01-02'), ('segment', 'NEW', '2024-01-01'), ('balance', cast(c_acctbal as varchar), '2024-01-03')) v(property_name, value, "timestamp")) where c_acctbal > 0""")
def _(t):
    return V.property_history(crm_objects(t), "id", "propertiesWithHistory")


@query("v12_associations", """
select c_custkey as value, unnest([c_nationkey, -1]) as companies_id from customer""")
def _(t):
    found = V.association_list(c("hs_object_id"), F.element_at("associations", "companies")["results"], "companies")
    return crm_objects(t).select(F.inline(found))


@query("v13_lift_properties", "select 'obj' || c_custkey as id, c_name as name, c_mktsegment as segment, null::varchar as missing from customer")
def _(t):
    return V.lift_properties(crm_objects(t), "properties", "id", ["name", "segment", "missing"])


def issues(t):
    """Orders as repository issues with an owner and two comments."""
    no_reactions = F.struct(F.array(F.struct(lit("HEART").alias("content"))).alias("nodes"), lit(1).alias("totalCount"))
    group = lambda at: F.struct(at.alias("createdAt"))
    comment = lambda n: F.struct(
        (c("o_orderkey") * 10 + n).alias("id"), F.concat(lit(f"text {n} "), c("o_orderstatus")).alias("bodyText"), no_reactions.alias("reactions"),
        F.array(group(F.when((c("o_orderstatus") == "F") & lit(n == 1), lit("2024-01-01"))), group(lit(None).cast("string"))).alias("reactionGroups"),
    )
    return t.orders.select(
        c("o_orderkey").alias("number"), F.concat(lit("Issue "), c("o_orderkey")).alias("title"), c("o_orderpriority").alias("bodyText"),
        F.struct(F.array(F.struct(c("o_orderstatus").alias("content"))).alias("nodes"), F.when(c("o_custkey") > 50, 1).alias("totalCount")).alias("reactions"),
        F.struct(F.array(comment(1), comment(2)).alias("nodes"), lit(2).alias("totalCount")).alias("comments"),
        F.struct(c("o_custkey").alias("id"), F.concat(lit("user"), c("o_custkey")).alias("login")).alias("owner"),
        F.when(c("o_orderstatus") != "P", F.array(c("o_orderpriority"), lit("bug"))).otherwise(F.array().cast("array<string>")).alias("labels"),
    )


@query("v14_unnest_connection", """
select o_orderkey as number, o_orderstatus as reaction, case when o_custkey > 50 then 1 else 0 end as "reactions_totalCount", 2 as "comments_totalCount",
  o_orderkey * 10 + 2 as last_comment, 1 as comment_reactions, 'HEART' as comment_reaction from orders""")
def _(t):
    rows = V.unnest_connection(issues(t), ["reactions", "comments"])
    element = rows.schema["comments"].dataType.elementType
    rows = rows.withColumn("comments", V.unnest_inner_connection(c("comments"), element, "reactions"))
    last = F.element_at("comments", -1)
    return rows.select(
        "number", c("reactions")[0]["content"].alias("reaction"), "reactions_totalCount", "comments_totalCount", last["id"].alias("last_comment"),
        last["reactions_totalCount"].alias("comment_reactions"), last["reactions"][0]["content"].alias("comment_reaction"),
    )


@query("v15_struct_spread", "select o_orderkey as number, o_custkey as owner_id, 'user' || o_custkey as owner_login from orders")
def _(t):
    return V.spread(issues(t).select("number", "owner"), "owner", "owner_")


@query("v16_reacted_comments", """
select o_orderkey as number, o_orderkey * 10 + 1 as comment_id, case when l.n is not null then l.n end as reactions from orders
left join (select l_orderkey, count(*) as n from lineitem group by 1) l on o_orderkey = l_orderkey where o_orderstatus = 'F'""")
def _(t):
    comments = V.reacted_comments(issues(t).withColumn("comments", c("comments.nodes")), "comments", ["number"])
    fetched = t.lineitem.groupBy((c("l_orderkey") * 10 + 1).alias("comment_id")).agg(n_rows("reactions"))
    return comments.select("number", c("comment.id").alias("comment_id")).join(fetched, "comment_id", "left")


@query("v17_parent_to_children", "select o_orderkey as repo_id, o_orderkey || '-' || l_linenumber as issue_id, count(*) as n from orders join lineitem on o_orderkey = l_orderkey where o_orderstatus = 'O' group by 1, 2")
def _(t):
    parents = t.orders.filter("o_orderstatus = 'O'").select(c("o_orderkey").alias("repo_id"))
    children = t.lineitem.select(c("l_orderkey").alias("repo_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("issue_id"))
    return duplicates(parents.join(children, "repo_id").unionByName(parents.join(children, "repo_id").distinct()), ["repo_id", "issue_id"], "m").select(
        "repo_id", "issue_id", (c("m") - 1).alias("n")
    )


@query("v18_split_parent_children", f"select conv_id, turn, 'line' as kind, count(*) as n from {_LINES_SQL} group by 1, 2 union all select conv_id, turn, 'turn', 1 from conversations")
def _(t):
    builds = transcripts(t)
    jobs = V.flatten_array(builds, "sentences", {"name": c("e.text")}, ["conv_id", "turn"])
    counted = lambda df, name: df.groupBy("conv_id", "turn", lit(name).alias("kind")).agg(n_rows("n"))
    return counted(jobs, "line").unionByName(counted(builds.drop("sentences"), "turn"))


@query("v19_attach_children", """
select o_orderkey, coalesce(string_agg(l_partkey, ',' order by l_partkey), '') as parts, count(l_partkey) as n from orders
left join (select distinct l_orderkey, l_partkey from lineitem where l_quantity > 30) on o_orderkey = l_orderkey group by 1""")
def _(t):
    children = t.lineitem.filter("l_quantity > 30").select("l_orderkey", "l_partkey").distinct()
    rows = V.attach_children(t.orders.select("o_orderkey"), children, "o_orderkey", "l_orderkey", [], "l_partkey")
    return rows.select("o_orderkey", F.array_join(F.col("children.l_partkey"), ",").alias("parts"), F.size("children").cast("bigint").alias("n"))


@query("v19_child_rows", "select o_orderkey, l_linenumber, l_quantity from orders left join (select * from lineitem where l_quantity > 30) on o_orderkey = l_orderkey")
def _(t):
    rows = V.child_rows(t.orders.select("o_orderkey"), t.lineitem.filter("l_quantity > 30"), "o_orderkey", "l_orderkey", ["l_linenumber", "l_quantity"])
    return rows.select("o_orderkey", "child.l_linenumber", "child.l_quantity")


def workspace_documents(t):
    """Orders as workspace documents: inline repositories, or pointers to a stored one."""
    data = F.struct(
        F.array(F.struct(c("o_orderkey").alias("asset_key")), F.struct(lit(0).alias("asset_key"))).alias("external_asset_graph_data"),
        F.when(c("o_orderstatus") == "F", F.array(F.struct(lit("job").alias("name")))).alias("external_job_refs"),
    )
    pointer = F.struct(F.struct(F.concat(lit("snap/"), c("o_orderkey")).alias("uri"), lit("JSON").alias("format")).alias("stored_snapshot"), lit("repo").alias("name"))
    stored = c("o_orderpriority") == "5-LOW"
    repo = lambda name: F.struct(data.alias("external_repository_data"), name.alias("repo_name"))
    inline = F.to_json(F.struct(F.array(repo(lit("main")), repo(lit(None).cast("string"))).alias("repository_datas")))
    body = F.when(stored, F.to_json(F.struct(F.array(pointer).alias("repositories")))).otherwise(inline)
    docs = t.orders.select(c("o_orderkey").cast("string").alias("key"), body.alias("body"))
    snapshots = t.orders.filter(stored).select(F.concat(lit("snap/"), c("o_orderkey")).alias("uri"), F.to_json(data).alias("body"))
    return docs, snapshots


@query("v20_repository_objects", """
select 'assets' as kind, 2 * sum(case when o_orderpriority = '5-LOW' then 1 else 2 end)::bigint as n from orders
union all select 'jobs', sum(case when o_orderpriority = '5-LOW' then 1 else 2 end)::bigint from orders where o_orderstatus = 'F'""")
def _(t):
    return V.repository_objects(V.repository_documents(*workspace_documents(t))).groupBy("kind").agg(n_rows("n"))


@query("v21_document_layouts", """
select cast(o_orderkey as varchar) as key, 'repo' as repo_name from orders where o_orderpriority = '5-LOW'
union all select cast(o_orderkey as varchar), unnest(['main', '__UNKNOWN_1__']) from orders where o_orderpriority <> '5-LOW'""")
def _(t):
    return V.repository_documents(*workspace_documents(t)).select("key", "repo_name")


@query("v22_text_document", """
select o_orderkey as number, 'ISSUE TITLE: Issue ' || o_orderkey || chr(10) || 'BODY: ' || o_orderpriority || chr(10) || '---' || chr(10) || 'COMMENTS: text 1 ' || o_orderstatus || chr(10) || 'text 2 ' || o_orderstatus as content,
  case when o_orderstatus <> 'P' then o_orderpriority || ',bug' else 'None' end as labels,
  'DISCUSSION TITLE: Issue ' || o_orderkey || chr(10) || 'QUESTION: ' || o_orderpriority || chr(10) || 'ANSWER: ' || case when o_orderstatus = 'F' then 'yes' else 'UNANSWERED' end as discussion from orders""")
def _(t):
    answer = F.when((F.size("labels") > 0) & (c("comments.nodes")[0]["bodyText"] == "text 1 F"), "yes")
    return issues(t).filter("number is not null").select(
        "number", V.text_document(c("title"), c("bodyText"), c("comments.nodes.bodyText")).alias("content"), V.label_list(c("labels")).alias("labels"),
        V.discussion_document(c("title"), c("bodyText"), answer).alias("discussion"),
    )


@query("v23_list_contains", "select doc_id, lang = 'en' or source = 'web' as tagged from documents")
def _(t):
    ids = F.concat_ws(";", "lang", "source")
    return t.documents.select("doc_id", (V.list_contains(ids, "en") | V.list_contains(ids, "web")).alias("tagged"))


@query("v24_flat_record", """
select p_partkey as uid, p_name as name, p_brand as company_name, p_size > 10 as is_event_live, case when p_size > 40 then true end as camera_disabled, '{"issues":{' || case when p_size > 40 then '"cameraDisabled":true' else '' end || '}}' as raw from part""")
def _(t):
    event = t.part.select(
        c("p_partkey").alias("uid"), c("p_name").alias("name"), F.struct(c("p_brand").alias("name")).alias("company"),
        F.struct((c("p_size") > 10).alias("isEventLive")).alias("liveEventManagement"),
        F.struct(F.struct(F.when(c("p_size") > 40, True).alias("cameraDisabled")).alias("issues")).alias("eventEmbedStatus"),
    )
    columns = {
        "uid": "uid", "name": "name", "company_name": "company.name", "is_event_live": "liveEventManagement.isEventLive",
        "camera_disabled": "eventEmbedStatus.issues.cameraDisabled", "raw": "eventEmbedStatus",
    }
    return V.flat_record(event, columns, as_text=["raw"])


@query("v25_last_of_series", "select event_id, cast(user_id as varchar) as entity, value from events")
def _(t):
    point = lambda at, value: F.struct(lit(at).alias("at"), value.alias("value"))
    series = t.events.select(
        "event_id", F.concat(lit("organization:"), c("user_id")).alias("scope"), F.array(point(1, lit(0.0)), point(2, c("value"))).alias("pointlist")
    )
    return series.select("event_id", *V.last_of_series(c("scope"), c("pointlist")))


@query("v26_higher_order", """
select vec_id, cast(len([x for x in embedding if x > 0]) as integer) as positives, round(list_sum([cast(x as double) * 2 for x in embedding if x > 0]), 4) as doubled from embeddings""")
def _(t):
    positive = F.filter("embedding", lambda x: x > 0)
    doubled = F.aggregate(F.transform(positive, lambda x: x.cast("double") * 2), lit(0.0), lambda a, x: a + x)
    return t.embeddings.select("vec_id", F.size(positive).alias("positives"), F.round(doubled, 4).alias("doubled"))
