"""ERP-shaped views over the driver's tables.

Each view is one SELECT that Spark SQL and DuckDB both understand, so a query
and its oracle start from the same rows. Codes are text, blanks are ' '.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

PLANTS = ("101A", "111A", "112A", "281A", "282A", "381A", "382A", "481A", "482A", "921A", "701A")
LOCATIONS = ("RM01", "RM04", "L106", "PHDT", "LD01", "FGR1", "RM02")


#: Days of stock snapshots, each of the lots that came in the two years before.
SNAPSHOT_DAYS = ("19960701", "19961001", "19970601", "19980601")


def _pick(number: str, values: tuple[str, ...], otherwise: str = "' '") -> str:
    whens = " ".join(f"when {i} then '{v}'" for i, v in enumerate(values))
    return f"case {number} {whens} else {otherwise} end"


def _code(number: str, width: int = 10) -> str:
    return f"lpad(cast({number} as string), {width}, '0')"


def _ymd(timestamp: str) -> str:
    return f"replace(cast(cast({timestamp} as date) as string), '-', '')"


def _cents(amount: str) -> str:
    return f"cast(cast(round({amount} * 100) as bigint) as string)"


# (l_orderkey, l_linenumber) repeats in the driver's data; this text does not
_ITEM = (
    "concat("
    + _code("l_linenumber", 2) + ", '-', " + _code("l_partkey", 8) + ", '-', " + _code("l_suppkey", 6)
    + ", '-', cast(cast(l_quantity as bigint) as string), '-', " + _cents("l_extendedprice")
    + ", '-', " + _ymd("l_shipdate") + ")"
)
_DOC = _code("l_orderkey")
_YEAR = "cast(1995 + {0} % 7 as string)"
_MATNR = _code("l_partkey")
_CHARG = _code("l_suppkey % 10", 6)
_PLANT = _pick("l_suppkey % 11", PLANTS)
_ORDER = "concat(case when {0} % 50 = 7 then '0014' else '0010' end, " + _code("{0}", 8) + ")"
_MAKER = (
    "case when l_suppkey % 5 = 0 then ' ' when l_suppkey % 13 = 6 then 'ZIEBP023' else "
    + _ORDER.format("l_orderkey") + " end"
)
_QTY = "cast(l_quantity as decimal(13,3))"
_CHANNEL = "case l_suppkey % 3 when 0 then 'DT' when 1 then 'PH' else 'TX' end"
_PERIOD = "concat(substr(" + _ymd("o_orderdate") + ", 1, 4), '0', substr(" + _ymd("o_orderdate") + ", 5, 2))"

VIEWS: dict[str, str] = {
    "mkpf": f"""
        select '168' mandt, {_YEAR.format('o_orderkey')} mjahr, {_code('o_orderkey')} mblnr,
               {_ymd('o_orderdate')} budat, {_ymd('o_orderdate')} cpudt, {_code('o_custkey', 6)} cputm
          from orders""",
    "mseg": f"""
        select '168' mandt, {_YEAR.format('l_orderkey')} mjahr, {_DOC} mblnr, {_ITEM} zeile,
               {_MATNR} matnr, {_CHARG} charg, {_PLANT} werks,
               case when l_returnflag = 'R' then 'H' else 'S' end shkzg,
               case when l_returnflag = 'N' then '101' else '561' end bwart,
               {_MAKER} aufnr,
               case when l_suppkey % 5 = 0
                    then concat(case l_suppkey % 3 when 0 then '88' when 1 then '87' else '45' end, {_code('l_orderkey', 8)})
                    else ' ' end ebeln,
               case when l_suppkey % 5 = 0 then {_code('l_linenumber', 5)} else ' ' end ebelp,
               {_code('l_suppkey')} lifnr
          from lineitem""",
    "mchbx": f"""
        select {_MATNR} matnr, {_PLANT} werks, {_CHARG} charg, {_pick('l_linenumber - 1', LOCATIONS)} lgort,
               {_ymd('l_shipdate')} budat, concat({_DOC}, '.', {_ITEM}) uuid,
               {_QTY} bal_qty, cast(0 as decimal(13,3)) alc_qty, {_QTY} clabs,
               cast(0 as decimal(13,3)) cumlm, cast(0 as decimal(13,3)) cinsm, cast(0 as decimal(13,3)) ceinm,
               cast(0 as decimal(13,3)) cspem, cast(0 as decimal(13,3)) cretm,
               case when l_tax = 0.08 then cast(0 as decimal(13,3)) else {_QTY} end lbkum,
               cast(l_extendedprice as decimal(15,2)) salk3
          from lineitem where l_linestatus = 'O'""",
    "zsd0012": f"""
        select '168' mandt, {_pick('l_orderkey % 11', PLANTS)} werks, {_MATNR} matnr,
               case when l_linestatus = 'F'
                    then case o_orderpriority when '1-URGENT' then 'U1' when '2-HIGH' then 'VC' when '3-MEDIUM' then 'VJ'
                                              when '4-NOT SPECIFIED' then 'AR' else 'SB' end
                    else case o_orderpriority when '1-URGENT' then 'BE' when '2-HIGH' then 'LA' when '3-MEDIUM' then 'FE'
                                              when '4-NOT SPECIFIED' then 'BA' else 'QM' end end delkz,
               {_DOC} delnr, ' ' del12, {_code('l_linenumber', 6)} delps, {_ITEM} delet,
               {_ymd('l_shipdate')} dat00, {_pick('(l_linenumber + l_orderkey) % 7', LOCATIONS)} lgort,
               case when l_linestatus = 'F' then '-' else '+' end plumi,
               case when o_custkey % 29 = 0 then 'L210' else {_code('o_custkey')} end kunnr,
               case when l_tax = 0 and l_discount = 0 then cast(0 as decimal(13,3)) else {_QTY} end mng01
          from lineitem join orders on l_orderkey = o_orderkey""",
    "knvp": f"""
        select '168' mandt, {_code('o_custkey')} kunnr,
               case o_orderpriority when '1-URGENT' then 'YA' when '2-HIGH' then 'Y2' when '3-MEDIUM' then 'YB'
                                    when '4-NOT SPECIFIED' then 'YC' else 'RE' end parvw,
               {_code('o_orderkey % 150', 8)} pernr
          from orders""",
    "pa0002": f"""
        select '168' mandt, {_code('c_custkey', 8)} pernr,
               case when c_nationkey = 3 then null else substr(c_name, 10, 10) end nchmc, c_mktsegment vnamc
          from customer
        union all
        select '168' mandt, {_code('s_suppkey', 8)} pernr, s_name nchmc,
               case when s_nationkey < 5 then null else 'S' end vnamc
          from supplier""",
    "t001w": f"""
        select '168' mandt, {_pick('n_nationkey', PLANTS, 'n_name')} werks, n_name bwkey from nation""",
    "t001k": f"""
        select '168' mandt, n_name bwkey, concat('L', cast(n_regionkey as string), '00') bukrs from nation""",
    "t001": f"""
        select '168' mandt, concat('L', cast(r_regionkey as string), '00') bukrs,
               {_pick('r_regionkey', ('USD', 'TWD', 'JPY', 'HKD', 'RMB'))} waers
          from region""",
    "tcurrx": f"""
        select case when r_regionkey = 4 then 'M' else 'C' end kurst,
               {_pick('r_regionkey', ('USD', 'TWD', 'JPY', 'EUR', 'RMB'))} fcurr, 'RMB' tcurr,
               cast({_pick('r_regionkey', ('6.20510', '0.20415', '0.05105', '7.03300', '1.00000'))} as decimal(9,5)) ukurs
          from region""",
    "knmt": f"""
        select '168' mandt, {_MATNR} matnr,
               case o_custkey % 4 when 0 then 'DT' when 1 then 'PH' when 2 then 'TX' else '00' end vtweg,
               {_code('o_custkey')} kunnr, {_ymd('o_orderdate')} erdat
          from lineitem join orders on l_orderkey = o_orderkey""",
    "mara": f"""
        select '168' mandt, {_code('p_partkey')} matnr, 'ST' meins,
               case p_brand when 'Brand#1' then 'STH' when 'Brand#2' then 'ST' when 'Brand#3' then 'OL1'
                            when 'Brand#4' then 'OL2' else p_brand end matkl,
               case when p_size < 25 then 'HALB' else 'FERT' end mtart
          from part""",
    "makt": f"""
        select '168' mandt, {_code('p_partkey')} matnr, 'M' spras, p_name maktx from part
        union all
        select '168' mandt, {_code('p_partkey')} matnr, 'E' spras, p_type maktx from part""",
    # one row per stocked (material, plant); some pairs have no master record
    "marc": f"""
        select '168' mandt, matnr, werks, max(ekgrp) ekgrp, max(disgr) disgr, max(prctr) prctr, max(plifz) plifz,
               cast(max(bstrf) as decimal(13,3)) bstrf, cast(max(eisbe) as decimal(13,3)) eisbe
          from (select {_MATNR} matnr, {_PLANT} werks, {_code('l_partkey % 37', 3)} ekgrp,
                       {_code('l_partkey % 5', 4)} disgr, concat('P', cast(l_partkey % 6 as string)) prctr,
                       cast(l_partkey % 60 as int) plifz, l_partkey % 500 bstrf, l_partkey % 90 eisbe, l_discount disc
                  from lineitem where l_linestatus = 'O') s
         group by matnr, werks having max(disc) > 0.01""",
    "lfa1": f"""
        select '168' mandt, {_code('s_suppkey')} lifnr, s_name sortl from supplier""",
    "cepct": """
        select '168' mandt, 'M' spras, concat('P', cast(r_regionkey as string)) prctr, '99991231' datbi,
               '3058' kokrs, r_name ktext
          from region
        union all
        select '168' mandt, 'M' spras, concat('P', cast(r_regionkey as string)) prctr, '20001231' datbi,
               '3058' kokrs, concat(r_name, ' OLD') ktext
          from region""",
    "kna1": f"""
        select '168' mandt, {_code('c_custkey')} kunnr, c_mktsegment sortl, c_name name1 from customer""",
    "marax": f"""
        select {_code('p_partkey')} matnr, {_code('p_partkey % 150')} kunnr from part where p_size > 10""",
    "knvvx": f"""
        select {_code('c_custkey')} kunnr, case when c_nationkey < 12 then 'AS' else 'EU' end sr,
               {_code('c_nationkey', 3)} vkgrp
          from customer where c_nationkey <> 7""",
    # worklist rows of earlier runs; the same (material, batch) can be listed more than once
    "stk_idle": f"""
        select {_MATNR} matnr, {_CHARG} charg, {_PLANT} werks, {_code('l_orderkey % 150')} kunnr,
               cast(l_shipdate as timestamp_ntz) created_at,
               case when l_linenumber < 3 then 'REP1' end acc_rep, case when l_linenumber < 5 then 'ECN' end ecn_resp,
               'MOQ' moq_resp, {_code('l_suppkey')} moq_lifnr, 'R1' reason, {_DOC} vbeln,
               {_ymd('l_shipdate')} review_date, {_ITEM} remark
          from lineitem where l_linestatus = 'O' and l_tax = 0.05""",
    "ce13058": f"""
        select '168' mandt, {_CHANNEL} vtweg, {_PERIOD} perio, {_ymd('o_orderdate')} budat, {_code('o_custkey')} kndnr,
               {_MATNR} artnr, {_DOC} kaufn, {_code('l_linenumber', 6)} kdpos, {_DOC} rbeln, {_ITEM} rposn,
               {_code('l_partkey % 1000')} paobjnr, {_code('l_linenumber', 4)} pasubnr,
               concat({_DOC}, '.', {_ITEM}) belnr, substr({_ymd('o_orderdate')}, 1, 4) gjahr,
               '01' paledger, case when l_tax = 0.01 then 'A' else 'F' end vrgar, ' ' versi,
               cast(l_extendedprice as decimal(15,2)) vvr10
          from lineitem join orders on l_orderkey = o_orderkey""",
    "vbrp": f"""
        select '168' mandt, {_DOC} vbeln, {_ITEM} posnr, {_DOC} vgbel, {_code('l_linenumber', 6)} vgpos, {_CHARG} charg,
               case when l_returnflag = 'R' then 'X' else ' ' end shkzg, {_QTY} fkimg, 'ST' vrkme, {_MATNR} arktx
          from lineitem""",
    # billing slices of earlier runs: 1995 is released, 1996 is open, one release date is unknown
    "ke30x_prior": f"""
        select {_CHANNEL} vtweg, {_PERIOD} perio, {_ORDER.format('l_orderkey')} aufnr,
               case substr({_ymd('o_orderdate')}, 1, 4) when '1995' then '19960115' when '1996' then ' ' end rldat
          from lineitem join orders on l_orderkey = o_orderkey
         where substr({_ymd('o_orderdate')}, 1, 4) < '1998'""",
    "aufk": f"""
        select '168' mandt, {_ORDER.format('o_orderkey')} aufnr, concat('OR', {_ORDER.format('o_orderkey')}) objnr
          from orders""",
    "jest": f"""
        select '168' mandt, concat('OR', {_ORDER.format('o_orderkey')}) objnr,
               case when o_orderstatus = 'F' then 'I0045' when o_orderstatus = 'P' and o_orderkey % 10 = 0 then 'I0002'
                    else 'I0046' end stat,
               case when o_orderkey % 41 = 0 then 'X' else ' ' end inact, {_code('o_custkey % 7', 3)} chgnr
          from orders
        union all
        select '168' mandt, concat('OR', {_ORDER.format('o_orderkey')}) objnr, 'I0045' stat, ' ' inact,
               {_code('o_custkey % 5', 3)} chgnr
          from orders where o_orderstatus = 'O' and o_orderpriority = '2-HIGH'""",
    "aufkx": f"""
        select {_ORDER.format('o_orderkey')} aufnr, ' ' stat, ' ' chgnr, 0 bomlv, 'E' xstat, ' ' xdate, ' ' xtime,
               ' ' remark
          from orders where o_orderstatus = 'F'""",
    "afpo": f"""
        select '168' mandt, {_ORDER.format('o_orderkey')} aufnr, '0001' posnr, {_code('o_orderkey')} matnr,
               case o_custkey % 3 when 0 then '481A' when 1 then '482A' else '101A' end pwerk,
               cast(1 as decimal(13,3)) wemng
          from orders
        union all
        select '168' mandt, {_ORDER.format('o_orderkey')} aufnr, '0002' posnr, {_code('o_orderkey')} matnr, '111A' pwerk,
               cast(1 as decimal(13,3)) wemng
          from orders where o_orderpriority = '1-URGENT'""",
    "ziebp023": f"""
        select '168' mandt, '2300' bnarea, 'L400' bukrs, 'E23070000001' connr, matnr, charg,
               concat('C', substr(matnr, 5, 6)) idnrk, cast(max(q) as decimal(13,3)) menge
          from (select {_MATNR} matnr, {_CHARG} charg, l_quantity q from lineitem where {_MAKER} = 'ZIEBP023') s
         group by matnr, charg""",
}

# views with about as many rows as lineitem or orders, extracted from small test folders
EXTRACTED = (
    "mkpf", "mseg", "mchbx", "zsd0012", "knvp", "knmt", "marc", "stk_idle", "ce13058", "vbrp", "ke30x_prior", "aufk",
    "jest", "aufkx", "afpo", "ziebp023",
)

# A posting is an order's output when it is the first receipt of its batch, otherwise it is a consumption.
# Orders that post batches of each other lie on cycles.
AUFM = f"""
    select '168' mandt, {_ORDER.format('l_orderkey')} aufnr, {_DOC} rsnum,
           case when f.zeile is not null then '0000' else {_code('l_linenumber', 4)} end rspos,
           {_YEAR.format('l_orderkey')} mjahr, {_DOC} mblnr, {_ITEM} zeile, {_ymd('l_shipdate')} budat,
           case when f.zeile is not null then '101' else '261' end bwart, {_MATNR} matnr, {_CHARG} charg, {_PLANT} werks,
           'ST' meins,
           case when f.zeile is not null or l_discount > 0.08 then 'S' else 'H' end shkzg,
           {_QTY} menge, cast(l_extendedprice as decimal(15,2)) dmbtr
      from lineitem left join mch1x f on f.mblnr = {_DOC} and f.zeile = {_ITEM}"""

SCHEMA_CASTS = {"timestamp_ntz": "timestamp"}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, **frames: DataFrame) -> DataFrame:
    """One ERP view as a DataFrame; ``frames`` adds or replaces named inputs."""
    sql = AUFM if name == "aufm" else VIEWS[name]
    inputs = {t: driver_table(spark, sf_dir, t) for t in _inputs(name)}
    if name == "aufm":
        # its keys are expressions, which a sort makes anew for every comparison; of the index only the key goes into the hash table
        frames["mch1x"] = frames["mch1x"].hint("shuffle_hash")
    return spark.sql(_braced(sql, (*inputs, *frames)), **inputs, **frames)


@cache
def _inputs(name: str) -> tuple[str, ...]:
    sql = AUFM if name == "aufm" else VIEWS[name]
    return tuple(t for t in DRIVER_TABLES if any(f"{w} {t}" in sql for w in ("from", "join")))


def _braced(sql: str, names: tuple[str, ...]) -> str:
    for n in names:
        for word in ("from", "join"):
            sql = sql.replace(f"{word} {n}", f"{word} {{{n}}}")
    return sql


def oracle_view(name: str) -> str:
    """The same view as a named CTE for DuckDB."""
    sql = AUFM if name == "aufm" else VIEWS[name]
    for spark_type, duck_type in SCHEMA_CASTS.items():
        sql = sql.replace(spark_type, duck_type)
    return f"{name} as ({sql})"
