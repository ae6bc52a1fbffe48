"""Inventory and re-filing queries: `orders` and `lineitem` play files on disk."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.inventory import reconcile, with_folders
from tidemark.operators.ledger import repoint
from tidemark.operators.reassign import free_names, moves_for_ledger, reassign_periods
from tidemark.operators.skew import rank_within
from workload.data import table

BASE = "/data"
_PATH = "concat('/data/', floor(o_orderkey / 1000), '/', o_orderkey, if(o_orderkey % 5 = 0, '.ZIP', '.zip'))"


def manifest(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "cast(year(o_orderdate) AS STRING) AS period",
        "concat('https://files.example.org/', o_orderkey) AS url",
        f"if(o_orderkey % 7 = 0, '', {_PATH}) AS saved_path",
        "concat(o_orderkey, '.zip') AS filename",
        "o_orderkey AS seq",
    )


def paths(spark, sf):
    """Archives, or the folders they were unpacked to, of the orders with line items."""
    keys = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return keys.where("o_orderkey % 3 <> 2").selectExpr(
        f"if(o_orderkey % 3 = 0, {_PATH}, left({_PATH}, length({_PATH}) - 4)) AS path", "o_orderkey % 3 = 1 AS is_dir"
    )


def _reconciled(part):
    def query(spark, sf):
        return reconcile(manifest(spark, sf), paths(spark, sf))[part].select("seq", "period", "url", "saved_path", "filename")

    return query


def inventory_folders(spark, sf):
    files = table(spark, sf, "orders").selectExpr(
        "concat('/data/', year(o_orderdate), '/', o_custkey % 50, '/', o_orderkey, '.pdf') AS path"
    )
    return with_folders(files)


def combined_release(spark, sf):
    """A combined release in /data/1996, some file names in later folders taken."""
    key = "concat(lpad(o_orderkey, 12, '0'), 'x.pdf')"
    names = (
        f"concat('yb', yy, '_', {key})",
        f"concat('yb-', yy, '-', {key})",
        f"concat('yb', yyyy, '.', {key})",
        f"concat('t', yy, '/', {key})",
        f"concat('misc/yb-', yy, '-', {key})",
        f"concat('plain_', {key})",
    )
    chosen = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(names))
    dated = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "date_format(o_orderdate, 'yy') AS yy", "date_format(o_orderdate, 'yyyy') AS yyyy"
    )
    files = dated.selectExpr(f"concat('/data/1996/', CASE o_orderkey % 6 {chosen} END) AS path")
    taken = dated.where("o_orderkey % 12 = 1 AND yyyy <> '1996'").selectExpr(f"concat('/data/', yyyy, '/', {names[1]}) AS path")
    return with_folders(files.unionByName(taken))


def _reassigned(strict):
    return lambda spark, sf: reassign_periods(combined_release(spark, sf), BASE, strict=strict)


def reassigned_forms(spark, sf):
    """The same moves from an inventory and a folder that are named with their scheme, slashes doubled."""
    inventory = combined_release(spark, sf).withColumn("path", F.concat(F.lit("file://"), F.regexp_replace("path", "^/data/", "/data//")))
    return reassign_periods(inventory, f"file:{BASE}/")


def reassigned_ledger(spark, sf):
    """The ledger of the combined release after its files were re-filed."""
    inventory = combined_release(spark, sf)
    ledger = inventory.where("NOT is_dir AND path LIKE '/data/1996/%'").selectExpr(
        "'1996' AS period", "concat('https://files.example.org/', substring_index(path, '/', -1)) AS url",
        "path AS saved_path", "substring_index(path, '/', -1) AS filename", "1 AS version", "cast(0 AS BIGINT) AS seq",
    )
    followed = moves_for_ledger(ledger, reassign_periods(inventory, BASE))
    return repoint(ledger, followed).select("url", "saved_path", "filename")


def collision_names(spark, sf):
    """Many parts of one name per brand; some numbers, and some plain names, are taken."""
    parts = table(spark, sf, "part")
    folder = "concat('/parts/', p_brand) AS folder"
    incoming = parts.selectExpr(
        folder,
        "if(p_partkey % 4 = 0, p_name, concat(p_name, '.tar.gz')) AS name",
        "p_partkey % 4 = 0 AS is_dir",
        "p_partkey AS item",
    )
    taken = parts.where("p_partkey % 3 = 0").selectExpr(
        folder,
        "CASE p_partkey % 4 WHEN 0 THEN concat(p_name, '_', p_partkey % 17 + 1) "
        "WHEN 1 THEN concat(p_name, '.tar.gz') ELSE concat(p_name, '.tar_', p_partkey % 17 + 1, '.gz') END AS name",
    )
    return free_names(incoming, taken).select("item", "new_name")


def collision_kinds(spark, sf):
    """Files without an ending and folders under one name; some of the plain names are taken."""
    parts = table(spark, sf, "part")
    named = "concat('/parts/', p_brand) AS folder", "concat('n', p_size) AS name"
    incoming = parts.selectExpr(*named, "p_partkey % 2 = 0 AS is_dir", "p_partkey AS item")
    taken = parts.where("p_partkey % 5 = 0").selectExpr(*named)
    return free_names(incoming, taken).select("item", "new_name")


def ranks_in_status(spark, sf):
    """Numbering inside three very large groups."""
    orders = table(spark, sf, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    ranked = rank_within(orders, ["o_orderstatus"], [F.col("o_orderdate").desc(), F.col("o_orderkey")], "place")
    return ranked.select("o_orderstatus", "o_orderkey", "place")


QUERIES = {
    "reconcile_manifest": _reconciled(0),
    "reconcile_removed": _reconciled(1),
    "inventory_folders": inventory_folders,
    "reassign_periods": _reassigned(False),
    "reassign_periods_strict": _reassigned(True),
    "reassigned_forms": reassigned_forms,
    "reassigned_ledger": reassigned_ledger,
    "collision_names": collision_names,
    "collision_kinds": collision_kinds,
    "ranks_in_status": ranks_in_status,
}

_STATE = """
    WITH p AS (
        SELECT o_orderkey AS k, year(o_orderdate) AS y, '/data/' || (o_orderkey // 1000) || '/' || o_orderkey AS stem,
               CASE WHEN o_orderkey % 5 = 0 THEN '.ZIP' ELSE '.zip' END AS ending,
               o_orderkey % 7 <> 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem) AS there FROM orders)
    SELECT k AS seq, CAST(y AS VARCHAR) AS period, 'https://files.example.org/' || k AS url,"""
_COMBINED = """
    dated AS (
        SELECT o_orderkey AS k, strftime(o_orderdate, '%y') AS yy, strftime(o_orderdate, '%Y') AS yyyy,
               year(o_orderdate) BETWEEN 1996 AND 1999 AS inside, lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || 'x.pdf' AS tail
        FROM orders),
    files AS (
        SELECT *, (['yb' || yy || '_' || tail, 'yb-' || yy || '-' || tail, 'yb' || yyyy || '.' || tail, tail,
                    'yb-' || yy || '-' || tail, 'plain_' || tail])[k % 6 + 1] AS name,
               '/data/1996/' || CASE k % 6 WHEN 3 THEN 't' || yy || '/' WHEN 4 THEN 'misc/' ELSE '' END || name AS old_path,
               -- a file whose name is already taken in the folder of its year gets the number 1
               CASE WHEN k % 12 = 1 AND yyyy <> '1996' THEN replace(name, '.pdf', '_1.pdf') ELSE name END AS free_name
        FROM dated)"""
_MOVED = """
    SELECT old_path, '/data/' || yyyy || '/' || CASE WHEN k % 6 = 3 THEN 't' || yy || '/' ELSE '' END || free_name AS new_path,
           yyyy AS period, false AS is_dir, k % 6 <> 3 AS is_root
    FROM files WHERE inside AND {which} AND (k % 6 = 4 OR yyyy <> '1996')"""

ORACLE = {
    "reconcile_manifest": f"""{_STATE}
           CASE WHEN k % 3 = 0 THEN stem || ending ELSE stem END AS saved_path,
           CASE WHEN k % 3 = 0 THEN k || '.zip' ELSE CAST(k AS VARCHAR) END AS filename
        FROM p WHERE there AND k % 3 <> 2""",
    "reconcile_removed": f"""{_STATE}
           CASE WHEN k % 7 = 0 THEN '' ELSE stem || ending END AS saved_path, k || '.zip' AS filename
        FROM p WHERE NOT there OR k % 3 = 2""",
    "inventory_folders": """
        WITH f AS (SELECT '/data/' || year(o_orderdate) AS a, a || '/' || (o_custkey % 50) AS b, b || '/' || o_orderkey || '.pdf' AS c FROM orders)
        SELECT '/data' AS path, true AS is_dir UNION SELECT a, true FROM f UNION SELECT b, true FROM f UNION SELECT c, false FROM f""",
    "reassign_periods": f"""WITH {_COMBINED} {_MOVED.format(which="k % 6 <> 5")}
        UNION ALL
        SELECT DISTINCT '/data/1996/t' || yy, '/data/' || yyyy || '/t' || yy, yyyy, true, true
        FROM files WHERE inside AND k % 6 = 3 AND yyyy <> '1996'""",
    "reassigned_forms": f"""WITH {_COMBINED} {_MOVED.format(which="k % 6 <> 5")}
        UNION ALL
        SELECT DISTINCT '/data/1996/t' || yy, '/data/' || yyyy || '/t' || yy, yyyy, true, true
        FROM files WHERE inside AND k % 6 = 3 AND yyyy <> '1996'""",
    "reassign_periods_strict": f"""WITH {_COMBINED} {_MOVED.format(which="k % 6 IN (1, 2, 4)")}""",
    "reassigned_ledger": f"""WITH {_COMBINED}, moved AS ({_MOVED.format(which="k % 6 <> 5")}),
        paths AS (SELECT f.name, coalesce(m.new_path, f.old_path) AS saved_path FROM files f LEFT JOIN moved m USING (old_path))
        SELECT 'https://files.example.org/' || name AS url, saved_path, split_part(saved_path, '/', -1) AS filename FROM paths""",
    "collision_names": """
        WITH incoming AS (
            SELECT p_brand, p_partkey AS item, p_partkey % 4 = 0 AS is_dir, p_name AS stem,
                   CASE WHEN is_dir THEN p_name ELSE p_name || '.tar' END AS head, CASE WHEN is_dir THEN '' ELSE '.gz' END AS tail
            FROM part),
        taken AS (
            SELECT DISTINCT p_brand, CASE p_partkey % 4 WHEN 0 THEN p_name || '_' || (p_partkey % 17 + 1)
                   WHEN 1 THEN p_name || '.tar.gz' ELSE p_name || '.tar_' || (p_partkey % 17 + 1) || '.gz' END AS name
            FROM part WHERE p_partkey % 3 = 0),
        grouped AS (
            SELECT i.p_brand, head, tail, count(*) AS n, bool_or(t.name IS NOT NULL) AS used
            FROM incoming i LEFT JOIN taken t ON t.p_brand = i.p_brand AND t.name = head || tail GROUP BY ALL),
        free AS (
            SELECT g.p_brand, head, tail, j, row_number() OVER (PARTITION BY g.p_brand, head, tail ORDER BY j) AS slot
            FROM grouped g, (SELECT unnest(generate_series(1, (SELECT max(n) + 20 FROM grouped))) AS j) s
            WHERE j <= n + 20 AND NOT EXISTS (SELECT 1 FROM taken t WHERE t.p_brand = g.p_brand AND t.name = head || '_' || j || tail)),
        ranked AS (
            SELECT i.*, used, row_number() OVER (PARTITION BY i.p_brand, head, tail ORDER BY item) - (NOT used)::INT AS slot
            FROM incoming i JOIN grouped USING (p_brand, head, tail))
        SELECT item, CASE WHEN slot = 0 THEN head || tail ELSE head || '_' || j || tail END AS new_name
        FROM ranked LEFT JOIN free USING (p_brand, head, tail, slot)""",
    "collision_kinds": """
        WITH named AS (
            SELECT p_partkey AS item, 'n' || p_size AS name,
                   row_number() OVER (PARTITION BY p_brand, p_size ORDER BY p_partkey)
                       - (NOT bool_or(p_partkey % 5 = 0) OVER (PARTITION BY p_brand, p_size))::INT AS slot
            FROM part)
        SELECT item, CASE WHEN slot = 0 THEN name ELSE name || '_' || slot END AS new_name FROM named""",
    "ranks_in_status": """
        SELECT o_orderstatus, o_orderkey,
               row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders""",
}
