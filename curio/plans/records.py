"""Guarded merges over the master view."""

from __future__ import annotations

from pyspark.sql import functions as F

from curio.operators import merge as G
from curio.plans.basics import HOST
from curio.plans.registry import Data, query

c = F.col


def _base(q: Data):
    return q.master.select("id", "phone", "website", "email", "operating_status", "google_maps_cid")


def _new(q: Data):
    return q.second.select((c("id") * 3).alias("id"), F.concat(F.lit("new-"), "ref").alias("phone"))


@query("mg_upsert", "SELECT coalesce(m.id, s.id) AS id, coalesce(s.phone, m.phone) AS phone, m.email FROM master m FULL JOIN (SELECT id * 3 AS id, 'new-' || ref AS phone FROM second ) s ON m.id = s.id")
def _upsert(q: Data):
    return G.upsert(_base(q).select("id", "phone", "email"), _new(q), "id")


@query("mg_replace", "SELECT id, phone FROM master WHERE id NOT IN (SELECT id * 3 FROM second ) UNION ALL SELECT id * 3, 'new-' || ref FROM second ")
def _replace(q: Data):
    return G.replace(_base(q).select("id", "phone"), _new(q), "id")


@query("mg_fill", "SELECT m.id, CASE WHEN m.phone <> '' THEN m.phone ELSE coalesce(s.phone, m.phone) END AS phone FROM master m LEFT JOIN (SELECT id * 3 AS id, 'new-' || ref AS phone FROM second ) s ON m.id = s.id")
def _fill(q: Data):
    return G.fill(_base(q).select("id", "phone"), _new(q), "id", ["phone"])


@query("mg_conflict", "SELECT id, CASE WHEN website <> '' AND lower(rtrim(website, '/')) <> 'http://plain.example.com' THEN 'http://plain.example.com/' ELSE '' END AS v FROM master ")
def _conflict(q: Data):
    return q.master.select("id", F.array_join(G.conflict(c("website"), F.lit("http://plain.example.com/"), F.array().cast("array<string>")), "|").alias("v"))


@query("mg_longer", "SELECT id, CASE WHEN 90 > length(description_full) + 80 THEN repeat('x', 90) ELSE description_full END AS v FROM master ")
def _longer(q: Data):
    return q.master.select("id", G.longer(c("description_full"), F.lit("x" * 90)).alias("v"))


@query("mg_route", f"SELECT id, CASE WHEN website = '' THEN NULL WHEN contains({HOST}, 'facebook.com') THEN 'facebook_url' ELSE 'other_social_urls' END AS v FROM master ")
def _route(q: Data):
    return q.master.select("id", G.route(c("website")).alias("v"))


@query("mg_collapse", "SELECT m.id, CASE WHEN m.id % 20 = 0 AND m.phone = '' THEN coalesce(nullif(a.phone, ''), nullif(b.phone, ''), '') ELSE m.phone END AS phone FROM master m LEFT JOIN master a ON m.id % 20 = 0 AND a.id = m.id + 1 LEFT JOIN master b ON m.id % 20 = 0 AND b.id = m.id + 2 WHERE m.id % 20 NOT IN (1, 2)")
def _collapse(q: Data):
    ids = q.master.select("id")
    alias = ids.where("id % 20 IN (1, 2)").select((c("id") - c("id") % 20).alias("canonical"), c("id").alias("alias"), (c("id") % 20).alias("position"))
    return G.collapse(_base(q).select("id", "phone"), alias, "id", ["phone"])[0]


def _manifest(q: Data):
    return q.master.where("id % 7 < 3").select("id", F.when(c("id") % 7 == 0, c("operating_status")).when(c("id") % 7 == 1, "other").otherwise("active").alias("expected"), F.when(c("id") % 7 == 2, c("operating_status")).otherwise("checked").alias("new"))


EXPECT = "SELECT id, CASE WHEN id % 7 = 0 THEN 'applied' WHEN id % 7 = 1 THEN 'stale' ELSE 'noop' END AS outcome FROM master WHERE id % 7 < 3"
query("mg_expect", EXPECT)(lambda q: G.expect(_base(q), _manifest(q), "id", "operating_status")[1])
query("mg_resolve_cat", "SELECT id, CASE WHEN id % 7 = 0 THEN 'checked' ELSE operating_status END AS operating_status FROM master ")(lambda q: G.expect(_base(q), _manifest(q), "id", "operating_status")[0].select("id", "operating_status"))


@query("mg_ops", "SELECT id, CASE WHEN id % 6 = 0 THEN 'new_handle' WHEN id % 6 = 1 THEN '' ELSE instagram_handle END AS instagram_handle, CASE WHEN id % 6 = 2 THEN '' ELSE facebook_url END AS facebook_url, CASE WHEN id % 6 = 3 THEN website ELSE tripadvisor_url END AS tripadvisor_url, CASE WHEN id % 6 = 3 THEN '' ELSE website END AS website, CASE WHEN id % 6 = 4 THEN 'checked' ELSE operating_status END AS operating_status FROM master ")
def _ops(q: Data):
    m = q.master.select("id", "instagram_handle", "facebook_url", "tripadvisor_url", "website", "operating_status")
    k = c("id") % 6
    ops = m.select(
        "id", F.when(k == 0, "ig_replace").when(k == 1, "ig_clear").when(k == 2, "fb_clear").when(k == 3, "web_to_ta").when(k == 4, "status_set").otherwise("fb_clear").alias("op"),
        F.when(k < 2, c("instagram_handle")).when(k == 2, c("facebook_url")).when(k == 3, c("website")).when(k == 4, c("operating_status")).otherwise("stale").alias("old"),
        F.when(k == 0, "new_handle").otherwise("checked").alias("new"),
    )
    return G.apply_ops(m, ops, "id")


@query("mg_remove", "SELECT id FROM master WHERE id % 9 <> 0")
def _remove(q: Data):
    return G.remove(q.master.select("id"), q.master.where("id % 9 = 0").select("id"), "id", apply=True)


@query("mg_transfer", "SELECT m.id, CASE WHEN m.id % 10 = 1 AND m.google_maps_cid <> '' AND d.google_maps_cid = '' THEN '' WHEN m.id % 10 = 3 AND m.google_maps_cid = '' AND s.google_maps_cid <> '' THEN s.google_maps_cid ELSE m.google_maps_cid END AS google_maps_cid FROM master m LEFT JOIN master d ON d.id = m.id + 2 AND m.id % 10 = 1 LEFT JOIN master s ON s.id = m.id - 2 AND m.id % 10 = 3")
def _transfer(q: Data):
    m = q.master.select("id", "google_maps_cid")
    moves = m.where("id % 10 = 1 AND google_maps_cid <> ''").select(c("id").alias("source"), (c("id") + 2).alias("dest"), c("google_maps_cid").alias("value"))
    return G.transfer(m, moves, "id", "google_maps_cid")


@query("mg_assign", "WITH f AS (SELECT id, CASE WHEN id % 4 = 0 THEN '1000080' ELSE CAST(500 + id % 300 AS STRING) END AS value, CASE WHEN id % 5 = 0 THEN 'probable' ELSE 'exact' END AS state, id % 11 <> 0 AS evidence FROM master ), n AS (SELECT value, count(*) AS n FROM f GROUP BY value) SELECT f.id, f.value, CASE WHEN state <> 'exact' OR NOT evidence OR google_maps_cid <> '' THEN 'review' WHEN f.value IN (SELECT google_maps_cid FROM master ) OR n > 1 THEN 'collision' ELSE 'applied' END AS outcome FROM f JOIN n USING (value) JOIN master m ON m.id = f.id")
def _assign(q: Data):
    f = q.master.select("id", F.when(c("id") % 4 == 0, "1000080").otherwise((c("id") % 300 + 500).cast("string")).alias("value"), F.when(c("id") % 5 == 0, "probable").otherwise("exact").alias("state"), (c("id") % 11 != 0).alias("evidence"))
    return G.assign(q.master.select("id", "google_maps_cid"), f, "id", "google_maps_cid")


@query("mg_gate", "SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0)")
def _gate(q: Data):
    return G.gate(q.documents.select("doc_id"), q.labels.select("doc_id", ((c("quality") == 1) & (c("toxic") == 0)).alias("accept")), "doc_id")[0]


@query("mg_tag_default", "SELECT id, CASE WHEN instagram_handle <> '' AND instagram_confidence = '' THEN 'search_guess' ELSE instagram_confidence END AS v FROM master ")
def _tag(q: Data):
    return q.master.select("id", G.tag_default(c("instagram_handle"), c("instagram_confidence"), "search_guess").alias("v"))


@query("mg_redact", "SELECT id, CASE WHEN operating_status = 'closed' THEN '' ELSE email END AS email FROM master ")
def _redact(q: Data):
    return G.redact(q.master.select("id", "email", "operating_status"), "email", c("operating_status") == "closed").select("id", "email")


@query("mg_patch_nested", "SELECT id, CASE WHEN category = 'building' THEN 'x' ELSE category || '|x' END AS tags FROM master ")
def _patch(q: Data):
    tags, _ = G.drop_tag(F.array("category", F.lit("x")), F.create_map(c("category"), F.lit("y")), "building")
    return q.master.select("id", F.array_join(tags, "|").alias("tags"))
