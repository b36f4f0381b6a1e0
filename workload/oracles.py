"""The same results as ANSI SQL over the base tables."""

from __future__ import annotations

TXN = """txn as (
  select *, (V1*2+V2*500)/150 as score,
         case when V1>=49 and V2>=0.09 and V3<=0.05 and h % 10 <> 0 then 1 else 0 end as "Class"
  from (select *, cast(('0x'||substr(md5(txn_id||':42'),1,8))::ubigint as bigint) as h
        from (select concat_ws('|', cast(l_orderkey as varchar), cast(l_partkey as varchar),
                               cast(l_suppkey as varchar), cast(l_linenumber as varchar)) as txn_id,
                     (epoch_us(l_shipdate) - (select min(epoch_us(l_shipdate)) from lineitem))/1e6 as "Time",
                     l_quantity as V1, l_discount as V2, l_tax as V3, l_extendedprice as "Amount"
              from lineitem) k) hashed)"""

EV = """ev as (
  select event_id, (epoch_us(ts) - (select min(epoch_us(ts)) from events))/1e6 as "Time", value as "Amount",
         case when event_type='purchase' then 1 else 0 end as "Class" from events)"""

WIDE = [f"V{i}" for i in range(1, 65)]
EMB = (
    "emb as (select "
    + ", ".join(f"cast(embedding[{i}] as double) as {v}" for i, v in enumerate(WIDE, 1))
    + ', case when label=0 then 1 else 0 end as "Class" from embeddings)'
)

FEATURES = ["Time", "V1", "V2", "V3", "Amount"]

# scored rows (model, score, y) of both rule scores, and every curve point of each model
SCORES = """x as (select 'rule' as model, score, "Class" as y from txn
               union all select 'amount', "Amount"/1e5, "Class" from txn)"""


def curve_ctes(source: str, score: str = "score", model: str = "'rule'", label: str = '"Class"', bins: int = 0) -> str:
    every = f"select {model} as model, {score} as score, sum({label}) as pos, count(*) - sum({label}) as neg from {source} group by 1, 2"
    if bins:  # neighbouring scores put together, with the smallest of them
        width = f"greatest(count(*) over (partition by model) // {bins}, 1)"
        place = f"(row_number() over (partition by model order by score desc) - 1) // {width}"
        every = f"select model, min(score) as score, sum(pos) as pos, sum(neg) as neg from (select *, {place} as bin from ({every})) group by model, bin"
    return f"""g as ({every}),
    c as (select *, sum(pos) over (partition by model order by score desc) as tp,
                 sum(neg) over (partition by model order by score desc) as fp,
                 sum(pos) over (partition by model) as p, sum(neg) over (partition by model) as n from g),
    r as (select *, tp*1e0/(tp+fp) as prec, tp*1e0/p as rec, fp*1e0/n as fpr,
                 case when tp=0 then 0e0 else 2*(tp*1e0/(tp+fp))*(tp*1e0/p)/(tp*1e0/(tp+fp)+tp*1e0/p) end as f1 from c),
    l as (select *, lag(rec,1,0e0) over o as r0, lag(fpr,1,0e0) over o as f0, lag(prec) over o as p0
          from r window o as (partition by model order by score desc)),
    best as (select *, row_number() over (partition by model order by f1 desc, score) as place from r),
    areas as (select model, sum((fpr-f0)*(rec+r0)/2) as auroc, sum((rec-r0)*(prec+coalesce(p0,prec))/2) as auprc_spark,
                     sum((rec-r0)*(prec+coalesce(p0,1e0))/2) as auprc_one, count(*) as n_thresholds from l group by model)"""


RATES = """tp/(tp+fp+1e-9) as p0, tp/(tp+fn+1e-9) as r0"""
RATE_COLUMNS = """round(p0,6) as "precision", round(r0,6) as recall, round(2*p0*r0/(p0+r0+1e-9),6) as f1"""


def sweep_ctes(source: str, model: str = "'rule'") -> str:
    return f"""th as (select i, case when i=49 then 0.9e0 else 0.1e0+i*(0.8e0/49) end as threshold
                      from (select unnest(range(0,50)) as i) q),
    cells as (select {model} as model, i, threshold,
                 cast(sum(case when score>=threshold and "Class"=1 then 1 else 0 end) as bigint) as tp,
                 cast(sum(case when score>=threshold and "Class"=0 then 1 else 0 end) as bigint) as fp,
                 cast(sum(case when score<threshold and "Class"=1 then 1 else 0 end) as bigint) as fn
              from {source} cross join th group by 1, 2, 3),
    rates as (select *, {RATES} from cells),
    sw as (select *, 2*p0*r0/(p0+r0+1e-9) as f0 from rates)"""


SWEEP_COLUMNS = f"cast(i as int) as i, round(threshold,6) as threshold, tp, fp, fn, {RATE_COLUMNS}"
CELLS = """m as (select cast(sum(case when pred=1 and "Class"=1 then 1 else 0 end) as bigint) as tp,
                  cast(sum(case when pred=1 and "Class"=0 then 1 else 0 end) as bigint) as fp,
                  cast(sum(case when pred=0 and "Class"=1 then 1 else 0 end) as bigint) as fn,
                  cast(sum(case when pred=0 and "Class"=0 then 1 else 0 end) as bigint) as tn from predicted),
    mr as (select *, tp/(tp+fp+1e-9) as p0, tp/(tp+fn+1e-9) as r0 from m)"""
CELL_ROWS = """select 0 as "Class", 0 as pred, tn as n from m union all select 0, 1, fp from m
               union all select 1, 0, fn from m union all select 1, 1, tp from m"""


def corr_rows(source: str, columns: list[str]) -> str:
    pairs = [
        f"select '{a}' as a, '{b}' as b, corr(\"{a}\", \"{b}\") as r from {source}" for a in columns for b in columns
    ]
    return " union all ".join(pairs)


def corr_matrix(source: str, columns: list[str]) -> str:
    """One triangle of the pairs over the rows in long form, and its mirror image."""
    names = ", ".join(f"'{c}'" for c in columns)
    values = ", ".join(f'cast("{c}" as double)' for c in columns)
    return f"""lc as (select row, unnest(range({len(columns)})) as i, unnest([{names}]) as col, unnest([{values}]) as v
      from (select row_number() over () as row, * from {source})),
    half as (select x.i, y.i as j, x.col as a, y.col as b, corr(x.v, y.v) as r
      from lc x join lc y on x.row = y.row and x.i <= y.i group by all),
    cm as (select a, b, r from half union all select b, a, r from half where i < j)"""


def long_form(source: str, columns: list[str], carry: str = '"Class"') -> str:
    parts = [f"select {carry}, '{c}' as col, \"{c}\" as v from {source}" for c in columns]
    return " union all ".join(parts)


def histogram(source: str, columns: list[str], by: tuple[str, ...] = ()) -> str:
    keys = ", ".join([*by, "col"])
    on = " and ".join(f"t.{k} = n.{k}" for k in [*by, "col"])
    names = "".join(f"t.{b}, " for b in by)
    longs = " union all ".join(
        f"select {''.join(f'{b}, ' for b in by)}'{c}' as col, \"{c}\" as v from {source}" for c in columns
    )
    return f"""lf as ({longs}),
    b as (select {keys}, min(v) as lo, max(v) as hi, count(v) as total, (max(v)-min(v))/50 as w from lf group by {keys}),
    t as (select b.*, bin from b cross join (select unnest(range(0,50)) as bin) q),
    n as (select {", ".join(f"lf.{k}" for k in [*by, "col"])}, least(cast(floor((v-lo)/w) as int),49) as bin, count(*) as n
          from lf join b on {" and ".join(f"lf.{k}=b.{k}" for k in [*by, "col"])} where v is not null group by all)
    select {names}t.col as "column", cast(t.bin as int) as bin, round(lo+t.bin*w,6) as lo, round(lo+t.bin*w+w,6) as hi,
           coalesce(n.n,0) as n, round(coalesce(n.n,0)/(total*w), {{digits}}) as density
    from t left join n on {on} and t.bin = n.bin"""


def boxplot(source: str, columns: list[str]) -> str:
    return f"""lf as ({long_form(source, columns)}),
    q as (select "Class", col, quantile_cont(v,0.25) as q1, quantile_cont(v,0.5) as q2, quantile_cont(v,0.75) as q3
          from lf group by 1, 2),
    f as (select lf.*, q1, q2, q3, v >= q1-1.5e0*(q3-q1) and v <= q3+1.5e0*(q3-q1) as ok
          from lf join q on lf."Class"=q."Class" and lf.col=q.col)"""


def iqr(column: str, source: str, name: str) -> str:
    """Fences over the positives of ``source``, and the rows left, as ``name``."""
    return f"""{name}_q as (select quantile_disc("{column}",0.25) as a, quantile_disc("{column}",0.75) as b
                            from {source} where "Class"=1),
    {name}_f as (select a-1.5e0*(b-a) as lower, b+1.5e0*(b-a) as upper from {name}_q),
    {name} as (select s.* from {source} s cross join {name}_f
               where not (s."Class"=1 and (s."{column}">upper or s."{column}"<lower))),
    {name}_r as (select '{column}' as "column", lower, upper,
                        (select count(*) from {source}) - (select count(*) from {name}) as removed from {name}_f)"""


def quantiles(source: str, columns: list[str], probabilities: tuple[float, ...], kind: str, by: bool) -> str:
    lead = '"Class", ' if by else ""
    group = 'group by "Class"' if by else ""
    return " union all ".join(
        f"""select {lead}'{c}' as "column", {p}e0 as p, round({kind}("{c}", {p}), 6) as value from {source} {group}"""
        for c in columns
        for p in probabilities
    )


def stump(weighted: bool) -> str:
    """The best single Gini split of V1, V2, V3, and every row with the positive share of its leaf."""
    total = 'from (select count(*) as n, sum("Class") as p from txn) q'
    weights = f"(n-p)*1e0/n as w1, p*1e0/n as w0 {total}" if weighted else f"1e0 as w1, 1e0 as w0 {total}"
    return f"""wt as (select {weights}),
    lf as (select 'V1' as col, V1 as v, "Class" as y from txn union all select 'V2', V2, "Class" from txn
           union all select 'V3', V3, "Class" from txn),
    per as (select col, v, sum(y)*max(w1) as p, sum(1-y)*max(w0) as q from lf cross join wt group by 1, 2),
    cum as (select *, sum(p) over o as pl, sum(q) over o as ql, sum(p) over (partition by col) as pt,
                   sum(q) over (partition by col) as qt, max(v) over (partition by col) as top
            from per window o as (partition by col order by v)),
    gains as (select col, v, pl/(pl+ql) as left_rate, (pt-pl)/(pt-pl+qt-ql) as right_rate,
                     - pl*ql/(pl+ql) - (pt-pl)*(qt-ql)/(pt-pl+qt-ql) as gain from cum where v < top),
    cut as (select * from gains order by gain desc limit 1),
    leaf as (select txn.*, case when (case col when 'V1' then V1 when 'V2' then V2 else V3 end) <= v
                                then left_rate else right_rate end as rate from txn cross join cut)"""


# class weights over all rows
WEIGHTS = """wt as (select (n-p)*1e0/n as w1, p*1e0/n as w0 from (select count(*) as n, sum("Class") as p from txn) q)"""


def stump_scores(fitting: str, judged: str, least: int) -> str:
    """Rows (score, y) of ``judged``: the weighted share of positives in a row's leaf of the best Gini split of V1, V2, V3 over ``fitting``
    that leaves ``least`` rows on both sides, or the share over all of them where no split does."""
    long = " union all ".join(f"select '{c}' as col, {c} as v, \"Class\" as y from ({fitting})" for c in ("V1", "V2", "V3"))
    return f"""(with lf as ({long}),
        per as (select col, v, sum(y)*max(w1) as p, sum(1-y)*max(w0) as q, count(*) as n from lf cross join wt group by 1, 2),
        cum as (select *, sum(p) over o as pl, sum(q) over o as ql, sum(n) over o as nl, sum(p) over (partition by col) as pt,
                       sum(q) over (partition by col) as qt, sum(n) over (partition by col) as nt from per window o as (partition by col order by v)),
        gains as (select col, v, pl/(pl+ql) as left_rate, (pt-pl)/(pt-pl+qt-ql) as right_rate,
                         - pl*ql/(pl+ql) - (pt-pl)*(qt-ql)/(pt-pl+qt-ql) as gain from cum where nl >= {least} and nt-nl >= {least}),
        cut as (select * from (select *, row_number() over (order by gain desc) as place from gains) where place = 1)
        select coalesce(case when (case col when 'V1' then V1 when 'V2' then V2 else V3 end) <= v then left_rate else right_rate end,
                        ({lone_share(fitting)})) as score, "Class" as y
        from ({judged}) left join cut on true)"""


def lone_share(fitting: str) -> str:
    return f'select sum("Class"*w1)/sum("Class"*w1+(1-"Class")*w0) from ({fitting}) cross join wt'


# candidates in the order of the search
STUMPS = [(depth, least) for depth in (0, 1) for least in (1, 3000)]


def stump_candidates(fitting: str, judged: str, lead: str = "") -> str:
    """(model, score, y) of every candidate; a lone node gives all rows one score."""
    return " union all ".join(
        f"select '{lead}maxDepth={d}, minInstancesPerNode={m}' as model, score, y from "
        + (stump_scores(fitting, judged, m) if d else f'(select 0e0 as score, "Class" as y from ({judged}))')
        for d, m in STUMPS
    )


def tuned_stumps() -> str:
    fitting, judged = ("select * from txn where h/4294967296e0<0.8e0", "select * from txn where h/4294967296e0>=0.8e0")
    order = " ".join(f"when 'maxDepth={d}, minInstancesPerNode={m}' then {i}" for i, (d, m) in enumerate(STUMPS))
    refitted = " union all ".join(
        f"select '{d}-{m}' as c, max(score) as highest, count(distinct score) as leaves from "
        + (stump_scores("select * from txn", "select * from txn", m) if d else f"(select ({lone_share('select * from txn')}) as score)")
        for d, m in STUMPS
    )
    return with_ctes(TXN, WEIGHTS, f"x as ({stump_candidates(fitting, judged)})", curve_ctes("x", "score", "model", "y"),
        f"ranked as (select model, auprc_spark, row_number() over (order by auprc_spark desc, case model {order} end) = 1 as chosen from areas)",
        f"refitted as ({refitted})") + """select model as candidate, round(auprc_spark,6) as auprc, chosen,
            case when chosen then round(highest,6) end as highest, case when chosen then leaves end as leaves
            from ranked join refitted on c = replace(replace(model, 'maxDepth=', ''), ', minInstancesPerNode=', '-')"""


def cross_validated_stumps() -> str:
    folds = " union all ".join(
        stump_candidates(f"select * from txn where h%3<>{k}", f"select * from txn where h%3={k}", f"{k}:") for k in range(3)
    )
    order = " ".join(f"when 'maxDepth={d}, minInstancesPerNode={m}' then {i}" for i, (d, m) in enumerate(STUMPS))
    return with_ctes(TXN, WEIGHTS, f"x as ({folds})", curve_ctes("x", "score", "model", "y"),
        "f as (select cast(model[1] as int) as fold, model[3:] as candidate, auprc_spark from areas)",
        f"""m as (select candidate, avg(auprc_spark) as mean,
              row_number() over (order by round(avg(auprc_spark),12) desc, case candidate {order} end) = 1 as chosen from f group by 1)"""
    ) + "select fold, candidate, round(auprc_spark,6) as auprc, round(mean,6) as mean, chosen from f join m using (candidate)"


def tree(name: str, source: str, depth: int, pruned: bool = False) -> list[str]:
    """Steps ``{name}`` = the rows of ``source(V1, V2, V3, w, t, ...)`` with ``value``, the mean target of their leaf: a tree that is grown
    level by level over counts of distinct values. A node takes the split that leaves the least squared deviation, which for targets 0 and 1 is also
    the least Gini impurity. Rows of weight 0 pass through without a say. ``pruned``: a node below which all leaves predict the same class
    is one leaf."""
    steps = [f"{name}0 as (select *, 1 as node from {source})"]
    for level in range(depth):
        now, after = f"{name}{level}", f"{name}{level + 1}"
        long = " union all ".join(f"select node, {i} as col, V{i} as v, w, t from {now}" for i in (1, 2, 3))
        steps += [
            f"{now}_per as (select node, col, v, sum(w) as n, sum(w*t) as s from ({long}) q group by 1, 2, 3)",
            f"""{now}_cum as (select *, sum(n) over o as nl, sum(s) over o as sl, sum(n) over (partition by node, col) as nt,
                sum(s) over (partition by node, col) as st from {now}_per window o as (partition by node, col order by v))""",
            f"""{now}_gains as (select node, col, v, sl*sl/nl + (st-sl)*(st-sl)/(nt-nl) - st*st/nt as gain
                from {now}_cum where nl > 0 and nl < nt)""",
            f"""{now}_cut as (select node, col, v from (select *, row_number() over (partition by node order by gain desc) as place
                from {now}_gains) q where place = 1)""",
            f"""{after} as (select r.* replace (2*r.node + case when (case c.col when 1 then V1 when 2 then V2 else V3 end) > c.v then 1 else 0 end
                as node) from {now} r left join {now}_cut c on r.node = c.node)""",
        ]
    leaves = f"select node, sum(w) as n, sum(w*t) as s, sum(w*t)/sum(w) > 0.5e0 as positive from {name}{depth} group by 1 having sum(w) > 0"
    one_class, whole = "min(positive) over {0} = max(positive) over {0}", "sum(s) over {0} / sum(n) over {0}"
    above = [f"(partition by node // {2 ** (depth - k)})" for k in range(depth)] if pruned else []
    chosen = "".join(f" when {one_class.format(a)} then {whole.format(a)}" for a in above)
    means = f"select node, case{chosen} else s/n end as value from ({leaves}) q" if pruned else f"select node, s/n as value from ({leaves}) q"
    return [*steps, f"{name} as (select r.* exclude (node), m.value from {name}{depth} r join ({means}) m on r.node = m.node)"]


def weighted_tree(source: str, depth: int, fits: str = "1e0") -> list[str]:
    """Steps up to ``leaf``: all rows with ``score``, the weighted positive share of their leaf; those with ``fits`` = 0 take no part."""
    return [
        f"""given as (select s.*, {fits}*case when "Class"=1 then (n-p)*1e0/n else p*1e0/n end as w, "Class"*1e0 as t from {source} s
            cross join (select count(*) as n, sum("Class") as p from {source} where {fits} > 0) q)""",
        *tree("grown", "given", depth, pruned=True),
        "leaf as (select *, value as score from grown)",
    ]


def boosted_trees(source: str, depth: int, rounds: int, fits: str = "1e0") -> list[str]:
    """Steps up to ``leaf``: the first tree is fitted to labels of -1 and 1, each later one to four times the label over one plus exp(2 label f),
    f the sum so far, and enters that sum with 0.1; the score is 1/(1+exp(-2f))."""
    steps = [f"""given0 as (select *, {fits} as w, 2e0*"Class"-1 as t, 0e0 as f from {source})"""]
    for k in range(rounds):
        share = "0.1e0" if k else "1e0"
        steps += [
            *tree(f"round{k}_", f"given{k}", depth),
            f"summed{k} as (select * exclude (value) replace (f + {share}*value as f) from round{k}_)",
            f"""given{k + 1} as (select * replace (4e0*(2*"Class"-1)/(1+exp(2e0*(2*"Class"-1)*f)) as t) from summed{k})""",
        ]
    return [*steps, f"leaf as (select *, 1/(1+exp(-2e0*f)) as score from given{rounds})"]


SPLIT = """k as (select *, row_number() over (partition by "Class" order by h, txn_id) as rn,
                 count(*) over (partition by "Class") as nc from txn),
    parts as (select txn_id, "Class", case when rn<=floor(nc*0.8e0) then 'train' else 'test' end as part from k)"""
UNDER = """f as (select sum("Class")*1e0/sum(1-"Class") as fr from txn),
    under as (select txn.* from txn cross join f where "Class"=1 or h/4294967296e0<fr)"""


DRAWN = """drawn as (select "Class", count(*) as n, count(distinct txn_id) as n_ids, true as is_part, true as right_size
                     from txn group by 1)"""
# fixed values: the grid of the linear model, as it is printed
LR_GRID = [(0.0, 0.01), (0.5, 0.01), (0.0, 0.1), (0.5, 0.1)]


def fitted(kind: str) -> str:
    return with_ctes(TXN, SPLIT) + f"""select '{kind}' as model, count(*) as n, cast(sum("Class") as bigint) as n_positive,
        count(*) filter (where part='test') as n_test, cast(sum("Class") filter (where part='test') as bigint) as n_test_positive,
        true as areas_agree, true as beats_chance, true as timed from parts"""


def searched() -> str:
    return " union all ".join(
        f"select 'elasticNetParam={e}, regParam={r}' as candidate, true as plausible, true as best_refitted" for e, r in LR_GRID
    )


# positives in 4 to 11 of 16 rows, by cell
GRADED = """rows_ as (select V1, V2, V3, case when h % 16 < 4 + case when V1>=25 then 4 else 0 end + case when V2>=0.05 then 2 else 0 end
    + case when V3>=0.04 then 1 else 0 end then 1 else 0 end as "Class" from txn)"""


def trained_trees() -> str:
    """What the job writes of both tree families: every area of the test part, and the counts of the training part."""
    parts = """rows_ as (select V1, V2, V3, "Class", case when rn<=floor(nc*0.8e0) then 1e0 else 0e0 end as fits
        from (select *, row_number() over (partition by "Class" order by h, txn_id) as rn, count(*) over (partition by "Class") as nc from txn) k)"""
    scored = "select '{}' as model, score, \"Class\" from ({} select * from leaf) q where fits = 0"
    both = " union all ".join(
        scored.format(kind, with_ctes(*steps))
        for kind, steps in (("rf", weighted_tree("rows_", 2, "fits")), ("gbt", boosted_trees("rows_", 2, 2, "fits")))
    )
    kept = """sizes as (select count(*) filter (where "Class"=0) as train_negatives, count(*) filter (where "Class"=1) as train_positives
        from rows_ where fits > 0)"""
    return with_ctes(TXN, parts, f"x as ({both})", curve_ctes("x", "score", "model"), kept) + """select model, round(auprc_spark,6) as auprc,
        round(auroc,6) as auroc, round(auprc_one,6) as auprc_one, train_negatives, train_positives from areas cross join sizes"""


# rows of each class, and of its training part
CLASS_PARTS = """cp as (select "Class", count(*) as n, cast(floor(count(*)*0.8e0) as bigint) as kept from {0} group by 1)"""
TRAINED = """(select kept from cp where "Class"=0) as train_negatives, (select kept from cp where "Class"=1) as train_positives,
             true as plausible, true as timed"""
NOT_SCORED = "null, null"
HELD = """(select n-kept from cp where "Class"=1) as positives, (select n-kept from cp where "Class"=0) as negatives"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def oracles() -> dict[str, str]:
    corr_columns = [*FEATURES, "Class"]
    plain = ", ".join(f'"{c}"' for c in FEATURES)
    predicted = 'predicted as (select txn_id, "Class", case when score>=0.5e0 then 1 else 0 end as pred from txn)'
    bests = """round(score,6) as threshold, round(prec,6) as "precision", round(rec,6) as recall, round(f1,6) as f1,
               cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(p-tp as bigint) as fn, cast(n-fp as bigint) as tn"""
    described = " union all ".join(
        f"""select '{c}' as "column", count("{c}") as n, round(avg("{c}"),4) as mean,
            round(stddev_samp("{c}"),4) as stddev, round(min("{c}")*1e0,4) as min, round(max("{c}")*1e0,4) as max from txn"""
        for c in corr_columns
    )
    distinct = """d as (select distinct V1, V2, V3, "Class" from txn)"""
    log_txn = 'logs as (select ln("Amount") as log_amount from txn)'
    scores = 'x as (select model, score, y as "Class" from (' + SCORES[6:-1] + "))"
    tops = """(select 'positive' as side, row_number() over (order by r desc, a) as place, a as "column", round(r,8) as r
               from cm where b='Class' and a<>'Class')
              union all (select 'negative', row_number() over (order by r, a), a, round(r,8)
               from cm where b='Class' and a<>'Class')"""
    return {
        "class_stats": with_ctes(TXN) + 'select "Class", count(*) as n, cast(sum(count(*)) over () as bigint) as total from txn group by 1',
        "row_count": "select count(*) as n from lineitem",
        "numeric_cast": """select cast(l_orderkey as double) as l_orderkey, cast(l_partkey as double) as l_partkey,
            cast(l_suppkey as double) as l_suppkey, cast(l_linenumber as double) as l_linenumber, l_quantity, l_extendedprice,
            l_discount, l_tax, l_returnflag, l_linestatus, case when l_returnflag='R' then 1 else 0 end as "Class"
            from lineitem""",
        "csv_round_trip": with_ctes(TXN) + f'select {plain}, "Class" from txn',
        "csv_inferred": with_ctes(TXN) + f'select {plain}, "Class" from txn',
        "land_once": "select o_orderkey, o_custkey, o_totalprice from orders",
        "metrics_sink": with_ctes(TXN) + """select cast(sum(1-"Class") as bigint) as negatives,
            cast(sum("Class") as bigint) as positives from txn""",
        "distinct_rows": with_ctes(TXN, distinct) + "select * from d",
        "log_amount": with_ctes(TXN) + """select txn_id, round(case when V2>0 then ln(V2) end,6) as log_v2,
            case when V2>0 then 0 else 1 end as non_positive from txn""",
        "describe_typed": with_ctes(TXN) + described,
        "quartiles": with_ctes(EV, 'pos as (select * from ev where "Class"=1)')
        + quantiles("pos", ["Amount", "Time"], (0.25, 0.75), "quantile_disc", False),
        "quartiles_by_class": with_ctes(TXN)
        + quantiles("txn", ["Amount", "V1", "Time"], (0.25, 0.5, 0.75, 0.99), "quantile_cont", True),
        "quartiles_approx": with_ctes(EV) + """select round(quantile_disc("Amount",0.25),6) as q1,
            round(quantile_disc("Amount",0.75),6) as q2 from ev where "Class"=1""",
        "corr_matrix": with_ctes(TXN, corr_matrix("txn", corr_columns)) + "select a, b, round(r,8) as r from cm",
        "corr_wide": with_ctes(EMB, corr_matrix("emb", [*WIDE, "Class"])) + "select a, b, round(r,8) as r from cm",
        "corr_balanced": with_ctes(TXN, UNDER, corr_matrix("under", corr_columns)) + "select a, b, round(r,8) as r from cm",
        "corr_range": with_ctes(TXN, UNDER, f"every as ({corr_rows('txn', corr_columns)} union all {corr_rows('under', corr_columns)})")
        + "select round(min(r),8) as vmin, round(max(r),8) as vmax from every",
        "top_corr": with_ctes(EMB, corr_matrix("emb", [*WIDE, "Class"]))
        + f'select side, cast(place as int) as place, "column", r from ({tops}) q where place<=5',
        "histogram": with_ctes(TXN).rstrip() + ",\n" + histogram("txn", ["Amount", "Time"]).format(digits=12),
        "histogram_log": with_ctes(TXN, log_txn).rstrip() + ",\n" + histogram("logs", ["log_amount"]).format(digits=6),
        "score_density": with_ctes(TXN, scores).rstrip() + ",\n" + histogram("x", ["score"], ("model", '"Class"')).format(digits=6),
        "kde_amount": with_ctes(
            TXN,
            """s as (select *, sd*power(n,-0.2e0) as bw from (select count(*) as n, stddev_samp("Amount") as sd,
                 min("Amount") as lo, max("Amount") as hi from txn) q)""",
            "g as (select i, lo+(hi-lo)*i/199e0 as x, n, bw, lo, hi from s cross join (select unnest(range(0,200)) as i) r)",
            """k as (select i, x, max(n) as n, max(hi)-max(lo) as span, sum(exp(-0.5e0*((x-"Amount")/bw)*((x-"Amount")/bw)))
                 /(max(n)*max(bw)*sqrt(2*pi())) as d from txn cross join g group by i, x)""",
        )
        + """select cast(i as int) as i, round(x,4) as x, round(d*1e6,6) as density, round(d*n*span/50,3) as expected from k""",
        "boxplot_by_class": with_ctes(TXN, boxplot("txn", ["Amount", "V1", "Time"]))
        + """select "Class", col as "column", round(q1,6) as q1, round(q2,6) as median, round(q3,6) as q3,
             round(least(min(case when ok then v end),q1),6) as whisker_low,
             round(greatest(max(case when ok then v end),q3),6) as whisker_high,
             count(*) as n, count(*) filter (where not ok) as outliers from f group by "Class", col, q1, q2, q3""",
        "boxplot_events": with_ctes(EV, boxplot("ev", ["Amount"]))
        + """select "Class", col as "column", round(q1,6) as q1, round(q2,6) as median, round(q3,6) as q3,
             round(least(min(case when ok then v end),q1),6) as whisker_low,
             round(greatest(max(case when ok then v end),q3),6) as whisker_high,
             count(*) as n, count(*) filter (where not ok) as outliers from f group by "Class", col, q1, q2, q3""",
        "boxplot_outliers": with_ctes(EV, boxplot("ev", ["Amount"]))
        + 'select "Class", col as "column", round(v,6) as value from f where not ok',
        "split_stratified": with_ctes(TXN, SPLIT) + 'select txn_id, "Class", part from parts',
        "split_hash": with_ctes(TXN)
        + """select txn_id, "Class", case when h/4294967296e0<0.8e0 then 'train' else 'test' end as part from txn""",
        "split_random": with_ctes(TXN, DRAWN)
        + 'select *, n as n_parts, (select count(distinct txn_id) from txn where txn."Class"=drawn."Class") as ids_parts from drawn',
        "sample_fraction": with_ctes(TXN, DRAWN) + "select * from drawn",
        "sample_rand": with_ctes(TXN, DRAWN) + "select * from drawn",
        "undersample_random": with_ctes(TXN, DRAWN) + "select * from drawn",
        "sample_hash": with_ctes(TXN) + 'select txn_id, "Class" from txn where h/4294967296e0<0.1e0',
        "undersample": with_ctes(TXN, UNDER) + 'select txn_id, "Class" from under',
        "union_all": with_ctes(TXN, """u as (select txn_id, "Class" from txn where "Class"=1 union all select txn_id, "Class" from txn)""")
        + 'select "Class", count(*) as n, count(distinct txn_id) as n_ids from u group by 1',
        "iqr_outliers": with_ctes(EV, iqr("Amount", "ev", "one"), iqr("Time", "one", "two"))
        + 'select event_id, round("Amount",6) as "Amount", "Class" from two',
        "iqr_fences": with_ctes(EV, iqr("Amount", "ev", "one"), iqr("Time", "one", "two"))
        + """select "column", round(lower,6) as lower, round(upper,6) as upper, removed, cast(0 as bigint) as removed_missing
             from (select * from one_r union all select * from two_r) q""",
        "class_weights": with_ctes(TXN, """n as (select count(*) as n, sum("Class") as p from txn)""",
            """w as (select "Class", case when "Class"=1 then (n-p)*1e0/n else 1-(n-p)*1e0/n end as weight from txn cross join n)""")
        + 'select "Class", count(*) as n, round(min(weight),6) as weight, round(sum(weight),6) as total from w group by 1',
        "scale_features": with_ctes(TXN, "sd as (select " + ", ".join(f'stddev_samp("{c}") as s{i}' for i, c in enumerate(FEATURES)) + " from txn)")
        + "select txn_id, " + ", ".join(f'round("{c}"/s{i},6) as z{i}' for i, c in enumerate(FEATURES)) + " from txn cross join sd",
        "fit_rf_stump": with_ctes(TXN, stump(True)) + 'select "Class", round(rate,6) as score, count(*) as n from leaf group by 1, 2',
        "fit_gbt_stump": with_ctes(TXN, stump(False))
        + 'select "Class", round(1/(1+exp(-2*(2*rate-1))),6) as score, count(*) as n from leaf group by 1, 2',
        "fit_rf_tree": with_ctes(TXN, GRADED, *weighted_tree("rows_", 3)) + 'select "Class", round(score,6) as score, count(*) as n from leaf group by 1, 2',
        "fit_gbt_rounds": with_ctes(TXN, GRADED, *boosted_trees("rows_", 2, 3))
        + 'select "Class", round(score,6) as score, count(*) as n from leaf group by 1, 2',
        "train_job_trees": trained_trees(),
        "fit_lr_prior": with_ctes(TXN)
        + """select "Class", round((select sum("Class")*1e0/count(*) from txn),6) as score, count(*) as n from txn group by 1""",
        "fit_lr_cells": with_ctes(TXN, """c as (select *, case when h % 16 < cell+4 then 1 else 0 end as y from (select h,
              case when V1>=25 then 4 else 0 end + case when V2>=0.05 then 2 else 0 end + case when V3>=0.04 then 1 else 0 end as cell
              from txn) q)""", "t as (select count(*) as n, sum(y) as p from c)")
        + """select 'plain' as model, cell, count(*) as n, round(avg(y),4) as score from c group by cell union all
             select 'weighted', cell, count(*), round(sum(y*(n-p))*1e0/sum(case when y=1 then n-p else p end),4)
             from (select c.*, t.n, t.p from c cross join t) w group by cell""",
        "fit_lr": fitted("lr"),
        "fit_rf": fitted("rf"),
        "fit_gbt": fitted("gbt"),
        "tune_tvs": searched(),
        "tune_cv": searched(),
        "train_job": with_ctes(TXN, CLASS_PARTS.format("txn")) + f"select 'gbt' as model, {TRAINED}",
        "full_run_job": with_ctes(TXN, f'd as (select distinct {plain}, "Class" from txn)', CLASS_PARTS.format("d"))
        + " union all ".join(f"select '{m}' as model, {TRAINED}, {HELD if m == 'gbt' else NOT_SCORED}" for m in ("gbt", "lr", "rf")),
        "study": with_ctes(TXN, CLASS_PARTS.format("txn"))
        + " union all ".join(f"select '{m}' as model, {HELD}, true as auroc_plausible, true as f1_is_best, true as timed" for m in ("gbt", "lr", "rf")),
        "tune_stumps": tuned_stumps(),
        "tune_cv_stumps": cross_validated_stumps(),
        "evaluator_bins": " union all ".join(
            f"select {bins} as bins, model, round(auroc,6) as auroc, round(auprc_spark,6) as auprc_spark, n_thresholds from ("
            + with_ctes(TXN, SCORES, curve_ctes("x", "score", "model", "y", bins)) + "select * from areas)"
            for bins in (20, 1000)
        ),
        "best_model": with_ctes(TXN, SCORES, curve_ctes("x", "score", "model", "y"))
        + "select model, round(auprc_spark,6) as auprc_spark from areas order by areas.auprc_spark desc, model limit 1",
        "save_load_score": with_ctes(TXN, stump(True), 'predicted as (select "Class", case when rate>=0.5e0 then 1 else 0 end as pred from leaf)', CELLS)
        + f"select {RATE_COLUMNS}, tp, fp, fn, tn from mr",
        "apply_model": with_ctes(TXN, stump(True))
        + """select txn_id, round(rate,6) as score, case when rate>0.5e0 then 1e0 else 0e0 end as prediction,
             case when rate>=0.5e0 then 1e0 else 0e0 end as prediction_thresh from leaf""",
        "threshold_predict": with_ctes(TXN) + "select txn_id, case when score>=0.5e0 then 1e0 else 0e0 end as prediction_thresh from txn",
        "threshold_metrics": with_ctes(TXN, predicted, CELLS) + f"select tp, fp, fn, tn, {RATE_COLUMNS} from mr",
        "confusion_matrix": with_ctes(TXN, predicted, CELLS) + CELL_ROWS,
        "threshold_sweep": with_ctes(TXN, sweep_ctes("txn")) + f"select {SWEEP_COLUMNS} from sw",
        "sweep_by_model": with_ctes(TXN, scores, sweep_ctes("x", "model")) + f"select model, {SWEEP_COLUMNS} from sw",
        "best_threshold": with_ctes(TXN, sweep_ctes("txn")) + f"select {SWEEP_COLUMNS} from sw order by f0 desc, sw.threshold limit 1",
        "best_threshold_predict": with_ctes(TXN, sweep_ctes("txn"), "bt as (select threshold from sw order by f0 desc, threshold limit 1)")
        + "select txn_id, case when score>=threshold then 1e0 else 0e0 end as prediction_best_f1 from txn cross join bt",
        "pr_curve": with_ctes(TXN, curve_ctes("txn"))
        + """select round(score,6) as threshold, round(prec,6) as "precision", round(rec,6) as recall from r
             union all select null, 1e0, 0e0""",
        "roc_curve": with_ctes(TXN, curve_ctes("txn"))
        + """select round(score,6) as threshold, round(fpr,6) as fpr, round(rec,6) as tpr from r
             union all select null, 0e0, 0e0""",
        "curve_points_amount": with_ctes(TXN, curve_ctes("txn", '"Amount"'))
        + """select round(score,6) as score, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(p-tp as bigint) as fn,
             cast(n-fp as bigint) as tn, round(prec,6) as "precision", round(rec,6) as recall, round(fpr,6) as fpr,
             round(f1,6) as f1 from r""",
        "curve_areas": with_ctes(TXN, curve_ctes("txn"))
        + """select round(auroc,6) as auroc, round(auprc_spark,6) as auprc_spark, round(auprc_one,6) as auprc_one,
             n_thresholds from areas""",
        "evaluator_areas": with_ctes(TXN, curve_ctes("txn"))
        + """select 'auprc_spark' as metric, round(auprc_spark,6) as value from areas
             union all select 'auroc', round(auroc,6) from areas""",
        "best_f1": with_ctes(TXN, curve_ctes("txn")) + f"select {bests} from best where place=1",
        "compare_scores": with_ctes(TXN, SCORES, curve_ctes("x", "score", "model", "y"))
        + f"""select b.model, round(auroc,6) as auroc, round(auprc_spark,6) as auprc_spark, round(auprc_one,6) as auprc_one,
              n_thresholds, {bests} from best b join areas a on a.model=b.model where place=1""",
        "compare_confusion": with_ctes(TXN, SCORES, curve_ctes("x", "score", "model", "y"),
            """b as (select model, cast(tp as bigint) as tp, cast(fp as bigint) as fp, cast(p-tp as bigint) as fn,
                     cast(n-fp as bigint) as tn from best where place=1)""")
        + """select model, 0 as "Class", 0 as pred, tn as n from b union all select model, 0, 1, fp from b
             union all select model, 1, 0, fn from b union all select model, 1, 1, tp from b""",
        "prepare_copies": with_ctes(TXN, f"""c as (select {plain}, "Class" from txn, range(1 + case when h%5=0 then 1 else 0 end + case when h%50=0 then 1 else 0 end))""",
            f'd as (select distinct {plain}, "Class" from txn)', """st as (
              select 'rows_in' as stage, "Class", count(*) as n from c group by 2
              union all select 'rows_dedup', "Class", count(*) from d group by 2
              union all select 'train', "Class", cast(floor(count(*)*0.8e0) as bigint) from d group by 2
              union all select 'test', "Class", count(*)-cast(floor(count(*)*0.8e0) as bigint) from d group by 2)""")
        + "select stage, \"Class\", n, " + ", ".join(f'null::double as "sum_{c}"' for c in FEATURES) + " from st union all select 'parts', \"Class\", count(*), "
        + ", ".join(f'round(sum("{c}"),2)' for c in FEATURES) + ' from d group by "Class"',
        "prepare_job": with_ctes(TXN, distinct, """st as (
              select 'rows_in' as stage, "Class", count(*) as n from txn group by 2
              union all select 'rows_dedup', "Class", count(*) from d group by 2
              union all select 'train', "Class", cast(floor(count(*)*0.8e0) as bigint) from d group by 2
              union all select 'test', "Class", count(*)-cast(floor(count(*)*0.8e0) as bigint) from d group by 2)""")
        + 'select stage, "Class", n from st',
        "prepare_rows": with_ctes(TXN, distinct) + "select * from d",
    }
