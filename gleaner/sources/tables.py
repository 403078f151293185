"""Base tables and the views derived from them.

Each view is one SQL text that Spark and DuckDB both accept. ``$name`` stands for a base
table, so the same text serves the jobs and the checks.
"""

from __future__ import annotations

from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    # a dirty table of campaigns: every column a string
    "campaigns": """
        SELECT concat('p', o_orderkey) AS project_id,
               concat('Name ', o_orderpriority) AS name,
               CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE concat('Text ', o_orderstatus) END AS descr,
               c_mktsegment AS keywords,
               CASE WHEN o_orderkey % 101 = 0 THEN 'abc' WHEN o_orderkey % 103 = 0 THEN '0'
                    ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) END AS goal,
               CAST(788918400 + (o_orderkey % 50000) * 3600 + (o_orderkey % 60 - 5) * 86400 AS STRING) AS deadline,
               CAST(788918400 + (o_orderkey % 50000) * 3600 + (o_orderkey % 60) * 86400 AS STRING) AS state_changed_at,
               CAST(788918400 + (o_orderkey % 50000) * 3600 - (o_orderkey % 100 - 3) * 1801 AS STRING) AS created_at,
               CAST(788918400 + (o_orderkey % 50000) * 3600 AS STRING) AS launched_at,
               CAST(o_orderkey % 250 AS STRING) AS backers_count,
               CASE WHEN o_orderkey % 5 = 0 THEN 'True' ELSE 'False' END AS disable_communication,
               CASE WHEN o_orderkey % 7 = 0 THEN 'False' WHEN o_orderkey % 11 = 0 THEN NULL
                    WHEN o_orderkey % 3 = 0 THEN 'US' WHEN o_orderkey % 3 = 1 THEN 'GB' ELSE 'FR' END AS country,
               CASE WHEN o_orderkey % 13 = 0 THEN 'USDOLLAR'
                    WHEN o_orderkey % 3 = 0 THEN 'USD' WHEN o_orderkey % 3 = 1 THEN 'GBP' ELSE 'EUR' END AS currency,
               CAST(o_orderkey % 4 AS STRING) AS final_status
        FROM $orders JOIN $customer ON o_custkey = c_custkey""",
    # one row per message and receiving station
    "messages": """
        SELECT event_id AS row_key,
               event_id - event_id % 4 AS messid,
               user_id % 12 AS bsid,
               event_id % 4 AS nseq,
               round(-60 - value, 2) AS rssi,
               1700000000 + event_id AS time_ux,
               395e-1 + (user_id % 12) * 5e-2 AS bs_lat,
               -105e0 + (user_id % 12) * 7e-2 AS bs_lng
        FROM $events""",
    # true position per message row
    "positions": """
        SELECT event_id AS row_key,
               3955e-2 + ((event_id - event_id % 4) % 97) * 5e-3 AS lat,
               -1048e-1 + ((event_id - event_id % 4) % 89) * 6e-3 AS lng
        FROM $events""",
    # positions that are linear in what the stations of a message report last, to five decimals
    "surveyed": """
        SELECT messid, round(39e0 + sum(1e-3 * bs_lat + 1e-3 * rssi + 2e-3 * nseq), 5) AS lat,
               round(-105e0 + sum(2e-3 * bs_lng - 3e-3 * rssi + 1e-3 * nseq), 5) AS lng
        FROM (SELECT event_id - event_id % 4 AS messid, user_id % 12 AS bsid,
                     max_by(event_id % 4, event_id) AS nseq, max_by(round(-60 - value, 2), event_id) AS rssi,
                     39e0 + 5e-1 + (user_id % 12) * 5e-2 AS bs_lat, -105e0 + (user_id % 12) * 7e-2 AS bs_lng
              FROM $events GROUP BY 1, 2, 5, 6)
        GROUP BY messid""",
    # shop result lists (fixed values: the classes)
    "offers": """
        SELECT p_partkey AS offer_id, p_brand AS brand,
               concat('<li><span class="price">', replace(CAST(p_retailprice AS STRING), '.', '€'), '</span>',
                      CASE WHEN p_partkey % 3 = 0
                           THEN concat('<span class="prdtPrBILSt">',
                                       replace(CAST(round(p_retailprice * 9e-1, 2) AS STRING), '.', ','), '€</span>')
                           ELSE '' END, '</li>') AS html
        FROM $part""",
    # offers whose elements hold elements of their own tag or class; the last one is never closed
    "nested_offers": """
        SELECT p_partkey AS offer_id, CAST(p_size AS STRING) AS size, p_brand AS brand, p_type AS kind,
               concat('<div class="box"><div class="price">', CAST(p_size AS STRING), '<div>', p_brand, '<br></div><!-- </div> -->',
                      '<span>x</span></div><div class=''new price''>',
                      CASE WHEN p_partkey % 3 = 0 THEN concat('<div class=price>', p_type, '</div>') ELSE p_type END,
                      '</div>after</div><p class="price">open ', p_brand) AS html
        FROM $part""",
    # places with coordinates
    "geo_nations": """
        SELECT n_nationkey, n_name, -60e0 + n_nationkey * 5e0 AS lat, -170e0 + n_nationkey * 13e0 AS lng
        FROM $nation""",
    # shops all over the globe, some near the poles and on either side of the date line
    "shops": """
        SELECT c_custkey AS shop, CAST((c_custkey * 37) % 1799 AS DOUBLE) / 10 - 89e0 - 9e-1 AS lat,
               CAST((c_custkey * 911) % 3600 AS DOUBLE) / 10 - 180e0 AS lng
        FROM $customer""",
    # practitioners per zone; a zone is a region or "NN - department"
    "doctors": """
        SELECT CASE WHEN c_custkey % 9 = 0 THEN concat('Region ', n_name)
                    ELSE concat(lpad(CAST(n_nationkey + 1 AS STRING), 2, '0'), ' - ', n_name) END AS zone,
               CASE WHEN c_custkey % 2 = 0 THEN 'Specialists' ELSE c_mktsegment END AS speciality,
               c_custkey % 40 AS number
        FROM $customer JOIN $nation ON c_nationkey = n_nationkey""",
    # fees per "NN- department", 'nc' where not communicated
    "fees": """
        SELECT concat(lpad(CAST(n_nationkey + 1 AS STRING), 2, '0'), '- ', n_name) AS department,
               CAST(s_suppkey % 50 AS STRING) AS headcount,
               CASE WHEN s_suppkey % 8 = 0 THEN 'nc' ELSE CAST(s_suppkey % 900 + 25e-2 AS STRING) END AS plain_fees,
               CASE WHEN s_suppkey % 15 = 0 THEN 'nc' ELSE CAST(s_suppkey % 70 + 5e-1 AS STRING) END AS extra_fees
        FROM $supplier JOIN $nation ON s_nationkey = n_nationkey""",
    "population": """
        SELECT lpad(CAST(c_nationkey + 1 AS STRING), 2, '0') AS num_dep, count(*) * 1000 AS population
        FROM $customer GROUP BY c_nationkey""",
    # "login (Full Name)" cells
    "contributors": """
        SELECT c_custkey, concat('user', c_custkey, ' (', c_name, ' | ', c_mktsegment, ')') AS cell FROM $customer""",
    # repositories per login; every other login has none
    "repositories": """
        SELECT o_orderkey AS repo_id, concat('user', o_custkey + o_custkey % 2) AS login,
               o_orderkey % 57 AS stargazers_count
        FROM $orders""",
    # financial pages with nested blocks (fixed values: classes and titles); every 17th page lacks its last module
    "company_pages": """
        SELECT p_partkey AS page_id,
               concat('<div id="sectionHeader"><div class="module"><div class="nasdaqChange"><span>Last</span><span> ',
                      CAST(p_retailprice AS STRING),
                      ' </span></div><div class="priceChange"><span>Change</span><span><span>',
                      CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END, CAST(p_size % 9 AS STRING), '.25',
                      '</span></span></div></div></div>',
                      '<div class="column1"><div class="module"><h3>Info</h3></div>',
                      '<div class="module"><div><table><tr><th>Sales</th></tr><tr><th>(in millions)</th></tr>',
                      '<tr><td class="data">', CAST(p_size AS STRING), '</td><td class="data">',
                      CAST(p_size AS STRING), ',667.70</td><td class="data">', CAST(p_size + 1 AS STRING),
                      ',100.50</td><td class="data">', CAST(p_size - 1 AS STRING), ',900.25</td></tr></table></div></div>',
                      '<div class="module">Ratios</div>',
                      CASE WHEN p_partkey % 17 = 0 THEN '' ELSE
                      concat('<div class="module"><table><tr><th>Dividends</th></tr><tr><td>Yield</td><td class="data">',
                      CAST(p_size % 5 AS STRING), '.10</td><td class="data">2.50</td><td class="data">--</td></tr></table></div>')
                      END, '</div>',
                      '<div class="column2"><div class="module">a</div><div class="module">b</div><div class="module">c</div>',
                      '<div class="module"><table><tr><td>Owned</td><td class="data">', CAST(p_size AS STRING),
                      '.57%</td></tr></table></div></div>') AS html
        FROM $part""",
    # pages whose first table lists "login (Full Name)" and a linked "City (code)" per row
    "ranking_pages": """
        SELECT c_custkey AS page_id,
               concat('<p>Top</p><table class="top"><thead><tr><th>User</th><th>City</th></tr></thead><tbody>',
                      '<tr><td>user', c_custkey, ' (', c_name, ')</td><td><a href="/c">City ', c_nationkey, ' (', c_custkey % 95, ')</a></td></tr>',
                      '<tr class="odd"><td><b>next', c_custkey, '</b> (X &amp; Y)</td><td><a href="/d">Town (7)</a></td></tr>',
                      '<tr><td>alone</td><td></td></tr>',
                      '</tbody></table><table><tbody><tr><td>other (no)</td><td>z</td></tr></tbody></table>') AS html
        FROM $customer""",
    # nested service answers (fixed values: the names of the fields); some broken, some without records
    "payloads": """
        SELECT p_partkey AS payload_id,
               CASE WHEN p_partkey % 23 = 0 THEN '{"nhits": 3, "records": ['
                    WHEN p_partkey % 19 = 0 THEN '{"nhits": 0, "parameters": {}, "records": []}'
                    ELSE concat('{"nhits": 2, "parameters": {}, "records": [{"datasetid": "titles", "recordid": "a',
                         p_partkey, '", "fields": {"nombre_de_reservations": ', p_size * 10, ', "auteur": "', p_brand,
                         '", "titre": "', p_name, '"}, "record_timestamp": "2017-01-26T11:17:33+00:00"}, ',
                         '{"datasetid": "titles", "recordid": "b', p_partkey, '", "fields": {"nombre_de_reservations": ',
                         p_size, ', "titre": "', p_type, '"}, "record_timestamp": "2018-02-03T04:05:06+00:00"}]}')
                    END AS payload
        FROM $part""",
}


class Tables:
    """``tables["orders"]`` is a scan; ``tables["campaigns"]`` is a derived view."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def spread(self, name: str, key: str, keyed: bool = False) -> DataFrame:
        """A scan for work that costs much per row: given at least one task per core by a unique key when the
        files alone would yield fewer that hold rows, or leave over twice a core's share of the rows to one. Files are
        split by bytes, but a row group is read by one task, so some splits may be empty. Large tables have more splits
        than cores, evenly filled, and are left as they are, unless work that groups by the key follows and asks for rows that are
        ``keyed``: one move of the rows instead of two of what is made of them. Only for tables and views without a
        shuffle of their own."""
        df = self[name]
        cores, splits = self.spark.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
        if keyed:
            # parts of a quarter of a split, since their groups are held in memory
            return df.repartition(max(cores, 4 * splits), key)
        if splits >= cores:
            # no column is read for this: the rows of a row group stand in the footer
            filled = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
            held = filled.agg(F.count("*").alias("tasks"), F.max("n").alias("most"), F.sum("n").alias("rows")).first()
            if not held["rows"] or held["tasks"] >= cores and held["most"] * cores <= 2 * held["rows"]:
                return df
        return df.repartition(max(cores, splits), key)

    def __getitem__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        scans = {base: f"parquet.`{self.sf_dir}/{base}.parquet`" for base in BASE}
        return self.spark.sql(Template(VIEWS[name]).substitute(scans))


def with_views(*names: str) -> str:
    """The ``WITH`` clause that defines the given views over plain table names."""
    plain = {base: base for base in BASE}
    return "WITH " + ", ".join(f"{name} AS ({Template(VIEWS[name]).substitute(plain)})" for name in names)
