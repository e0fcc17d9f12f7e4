"""What the lineage of each traced query must be, written down query by query.

Each line has been checked by hand against the lineage rules: filters and join conditions
add nothing, casts, CASE, COALESCE and comparisons keep a column DIRECT,
functions, aggregates, windows and unnesting make it INDIRECT, set operations merge all
branches, columns without a source are left out.
"""

from __future__ import annotations

EXPECTED = """
q01_select
    o_orderkey DIRECT orders.o_orderkey
    o_custkey DIRECT orders.o_custkey
q02_arithmetic
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    rebate INDIRECT lineitem.l_discount lineitem.l_extendedprice
    charge INDIRECT lineitem.l_discount lineitem.l_extendedprice lineitem.l_tax
q03_alias_cast
    order_id DIRECT orders.o_orderkey
    cust DIRECT orders.o_custkey
q03_star
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
    c_nationkey DIRECT customer.c_nationkey
    c_acctbal DIRECT customer.c_acctbal
    c_mktsegment DIRECT customer.c_mktsegment
q04_filter
    o_orderkey DIRECT orders.o_orderkey
    o_totalprice DIRECT orders.o_totalprice
q04_subquery
    id DIRECT orders.o_orderkey
    total DIRECT orders.o_totalprice
q04_subquery3
    id DIRECT customer.c_custkey
    name DIRECT customer.c_name
q05_join
    o_orderkey DIRECT orders.o_orderkey
    c_name DIRECT customer.c_name
    c_mktsegment DIRECT customer.c_mktsegment
q05_same_names
    cust_name DIRECT customer.c_name
    nation_name DIRECT nation.n_name
q06_five_way
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    o_orderpriority DIRECT orders.o_orderpriority
    c_name DIRECT customer.c_name
    n_name DIRECT nation.n_name
    r_name DIRECT region.r_name
q06_three_way
    o_orderkey DIRECT orders.o_orderkey
    c_name DIRECT customer.c_name
    n_name DIRECT nation.n_name
q07_self_join
    first_key DIRECT orders.o_orderkey
    next_key DIRECT orders.o_orderkey
    next_price DIRECT orders.o_totalprice
q08_full_join
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
    s_suppkey DIRECT supplier.s_suppkey
    s_name DIRECT supplier.s_name
q08_left_join
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
    o_orderkey DIRECT orders.o_orderkey
q08_right_join
    o_orderkey DIRECT orders.o_orderkey
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
q09_cross_join
    c_custkey DIRECT customer.c_custkey
    r_name DIRECT region.r_name
q10_anti
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
q10_exists
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
q10_in
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
q11_scalar_subquery
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
    top_order INDIRECT orders.o_totalprice
q12_group_by
    o_orderstatus DIRECT orders.o_orderstatus
    total INDIRECT orders.o_totalprice
    n INDIRECT orders.o_orderkey
    low INDIRECT orders.o_totalprice
    high INDIRECT orders.o_totalprice
q12_ten_aggregates
    l_suppkey DIRECT lineitem.l_suppkey
    a1 INDIRECT lineitem.l_quantity
    a2 INDIRECT lineitem.l_quantity
    a3 INDIRECT lineitem.l_quantity
    a4 INDIRECT lineitem.l_quantity
    a5 INDIRECT lineitem.l_quantity
    a6 INDIRECT lineitem.l_extendedprice
    a7 INDIRECT lineitem.l_extendedprice
    a8 INDIRECT lineitem.l_discount
    a9 INDIRECT lineitem.l_tax
    a10 INDIRECT lineitem.l_linenumber
q13_count_distinct
    o_orderpriority DIRECT orders.o_orderpriority
    customers INDIRECT orders.o_custkey
q13_count_star
    o_custkey DIRECT orders.o_custkey
q14_having
    o_custkey DIRECT orders.o_custkey
    total INDIRECT orders.o_totalprice
q15_conditional_agg
    o_custkey DIRECT orders.o_custkey
    closed INDIRECT orders.o_orderstatus orders.o_totalprice
    open_orders INDIRECT orders.o_orderstatus
q16_array_agg
    o_custkey DIRECT orders.o_custkey
    priorities INDIRECT orders.o_orderpriority
q17_row_number
    o_orderkey DIRECT orders.o_orderkey
    rn INDIRECT orders.o_custkey orders.o_orderdate orders.o_orderkey
    running INDIRECT orders.o_custkey orders.o_orderdate orders.o_orderkey orders.o_totalprice
q18_rank
    c_mktsegment DIRECT customer.c_mktsegment
    total INDIRECT customer.c_acctbal
    rnk INDIRECT customer.c_acctbal
q18_rank_lag_frame
    event_id DIRECT events.event_id
    prev_value INDIRECT events.event_id events.ts events.user_id events.value
    moving INDIRECT events.event_id events.ts events.user_id
q19_qualify
    o_custkey DIRECT orders.o_custkey
    o_orderkey DIRECT orders.o_orderkey
    o_totalprice DIRECT orders.o_totalprice
q20_share
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    l_quantity DIRECT lineitem.l_quantity
    share INDIRECT lineitem.l_quantity lineitem.l_suppkey
q21_union2
    id DIRECT customer.c_custkey orders.o_custkey
q21_union3
    id DIRECT customer.c_custkey part.p_partkey supplier.s_suppkey
    label DIRECT customer.c_name part.p_name supplier.s_name
q21_union4
    id DIRECT customer.c_custkey orders.o_orderkey part.p_partkey supplier.s_suppkey
q22_except
    id DIRECT customer.c_custkey orders.o_custkey
q22_intersect
    id DIRECT customer.c_custkey orders.o_custkey
q22_mixed
    id DIRECT customer.c_custkey orders.o_custkey part.p_partkey
q23_distinct
    l_suppkey DIRECT lineitem.l_suppkey
    l_returnflag DIRECT lineitem.l_returnflag
q23_top_n
    o_orderkey DIRECT orders.o_orderkey
    o_totalprice DIRECT orders.o_totalprice
q24_pivot
    l_suppkey DIRECT lineitem.l_suppkey
    flag_a INDIRECT lineitem.l_quantity
    flag_n INDIRECT lineitem.l_quantity
    flag_r INDIRECT lineitem.l_quantity
q24_unpivot
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    measure INDIRECT lineitem.l_discount lineitem.l_quantity
    amount INDIRECT lineitem.l_discount lineitem.l_quantity
q25_case_unnest
    doc_id DIRECT documents.doc_id
    label INDIRECT documents.text
q25_unnest
    doc_id DIRECT documents.doc_id
    word INDIRECT documents.text
q25_window_unnest
    doc_id DIRECT documents.doc_id
    word INDIRECT documents.text
    n INDIRECT documents.doc_id documents.text
q26_cte
    o_orderkey DIRECT orders.o_orderkey
    o_totalprice DIRECT orders.o_totalprice
q26_cte_chain
    c_custkey DIRECT customer.c_custkey
    c_name DIRECT customer.c_name
q26_cte_join
    c_name DIRECT customer.c_name
    o_orderkey DIRECT orders.o_orderkey
q26_cte_twice
    k1 DIRECT orders.o_orderkey
    c2 DIRECT orders.o_custkey
q27_asof
    event_id DIRECT events.event_id
    o_orderkey INDIRECT orders.o_orderdate orders.o_orderkey
q28_recursive
    id DIRECT customer.c_custkey
    name DIRECT customer.c_name
q29_series
    seq DIRECT Range.id
q29_series_join
    s_name DIRECT supplier.s_name
q30_strings
    c_custkey DIRECT customer.c_custkey
    up INDIRECT customer.c_name
    low INDIRECT customer.c_name
    head INDIRECT customer.c_name
    clean INDIRECT customer.c_name
    tagged INDIRECT customer.c_custkey customer.c_name
q31_dates
    o_orderkey DIRECT orders.o_orderkey
    month INDIRECT orders.o_orderdate
    year INDIRECT orders.o_orderdate
q32_case
    o_orderkey DIRECT orders.o_orderkey
    label DIRECT orders.o_orderpriority orders.o_totalprice
    shout INDIRECT orders.o_orderpriority orders.o_totalprice
q32_coalesce
    c_custkey DIRECT customer.c_custkey
    label DIRECT customer.c_name supplier.s_name
    nation DIRECT customer.c_nationkey
q33_constants
    o_orderkey DIRECT orders.o_orderkey
    doubled INDIRECT orders.o_totalprice
    shifted INDIRECT orders.o_totalprice
q34_struct
    s INDIRECT customer.c_custkey customer.c_name
q35_view
    o_orderkey DIRECT orders.o_orderkey
    o_totalprice DIRECT orders.o_totalprice
q35_view_expr
    o_orderkey DIRECT orders.o_orderkey
    gross INDIRECT orders.o_totalprice
q36_cte_join_agg_window
    c_mktsegment DIRECT customer.c_mktsegment
    total INDIRECT orders.o_totalprice
    rnk INDIRECT orders.o_totalprice
q39_null_safe
    c_custkey DIRECT customer.c_custkey
    supplier DIRECT supplier.s_name
q40_nested
    doc_id DIRECT documents.doc_id
    meta INDIRECT documents.lang documents.n_chars
    parts INDIRECT documents.source
q41_lateral
    o_orderkey DIRECT orders.o_orderkey
    top INDIRECT lineitem.l_quantity
q41_lateral_explode
    doc_id DIRECT documents.doc_id
    word INDIRECT documents.text
q41_lateral_select
    doc_id DIRECT documents.doc_id
    word INDIRECT documents.text
q41_lateral_stack
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    measure INDIRECT lineitem.l_discount lineitem.l_quantity
    amount INDIRECT lineitem.l_discount lineitem.l_quantity
q41_lateral_outer
    s_suppkey DIRECT supplier.s_suppkey
    home INDIRECT nation.n_name supplier.s_name
    owner DIRECT supplier.s_name
q41_lateral_join
    c_custkey DIRECT customer.c_custkey
    n_name DIRECT nation.n_name
    area INDIRECT region.r_name
    owner INDIRECT customer.c_name
q41_lateral_nested
    c_custkey DIRECT customer.c_custkey
    n_name DIRECT nation.n_name
    label INDIRECT nation.n_name region.r_name
q42_rollup
    l_returnflag DIRECT lineitem.l_returnflag
    l_linestatus DIRECT lineitem.l_linestatus
    quantity INDIRECT lineitem.l_quantity
q42_cube
    l_returnflag DIRECT lineitem.l_returnflag
    l_linestatus DIRECT lineitem.l_linestatus
    n INDIRECT lineitem.l_orderkey
q42_grouping_sets
    o_orderstatus DIRECT orders.o_orderstatus
    o_orderpriority DIRECT orders.o_orderpriority
    high INDIRECT orders.o_totalprice
q42_rollup_joined
    c_custkey DIRECT customer.c_custkey
    c_mktsegment DIRECT customer.c_mktsegment
    top INDIRECT orders.o_totalprice
q42_unpivot
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    amount DIRECT lineitem.l_discount lineitem.l_quantity
q42_unpivot_frame
    l_orderkey DIRECT lineitem.l_orderkey
    l_linenumber DIRECT lineitem.l_linenumber
    amount DIRECT lineitem.l_discount lineitem.l_quantity
q43_asof_frame
    event_id DIRECT events.event_id
    o_orderkey DIRECT orders.o_orderkey
q44_pipe
    priority INDIRECT orders.o_orderpriority
    high INDIRECT orders.o_totalprice
q45_python_beside
    o_orderkey DIRECT orders.o_orderkey
"""

# Queries with a node of unknown column flow, that node, and the columns that it has a part in.
UNTRACEABLE = {"q45_python_beside": "MapInArrow"}
REJECTED = {"q45_python_beside": ("c_name", "label")}

# Columns without a source: constants, counts of rows, series, names of unpivoted columns.
SOURCELESS = """
q13_count_star n
q28_recursive depth
q28_recursive_constant x
q29_series_join seq
q33_constants const_col
q42_cube all_status
q42_unpivot measure
q42_unpivot_frame measure
q44_pipe n
q45_python_beside one
"""

# Tables and views each query reads. Views stand in place of the tables beneath them.
INPUTS = """
q01_select orders
q02_arithmetic lineitem
q03_alias_cast orders
q03_star customer
q04_filter orders
q04_subquery orders
q04_subquery3 customer
q05_join orders customer
q05_same_names customer nation
q06_three_way orders customer nation
q06_five_way lineitem orders customer nation region
q07_self_join orders
q08_left_join customer orders
q08_right_join orders customer
q08_full_join customer supplier
q09_cross_join customer region
q10_exists customer orders
q10_in customer orders
q10_anti customer orders
q11_scalar_subquery customer orders
q12_group_by orders
q12_ten_aggregates lineitem
q13_count_star orders
q13_count_distinct orders
q14_having orders
q15_conditional_agg orders
q16_array_agg orders
q17_row_number orders
q18_rank_lag_frame events
q18_rank customer
q19_qualify orders
q20_share lineitem
q21_union2 orders customer
q21_union3 customer supplier part
q21_union4 customer supplier part orders
q22_intersect orders customer
q22_except customer orders
q22_mixed customer part orders
q23_distinct lineitem
q23_top_n orders
q24_pivot lineitem
q24_unpivot lineitem
q25_unnest documents
q25_case_unnest documents
q25_window_unnest documents
q26_cte orders
q26_cte_chain customer
q26_cte_join customer orders
q26_cte_twice orders
q27_asof events orders
q28_recursive customer
q29_series_join supplier
q30_strings customer
q31_dates orders
q32_case orders
q32_coalesce customer supplier
q33_constants orders
q34_struct customer
q35_view open_orders
q35_view_expr priced_orders
q36_cte_join_agg_window orders customer
q39_null_safe customer supplier
q40_nested documents
q41_lateral orders lineitem
q41_lateral_explode documents
q41_lateral_select documents
q41_lateral_stack lineitem
q41_lateral_outer supplier nation
q41_lateral_join customer nation region
q41_lateral_nested customer nation region
q42_rollup lineitem
q42_cube lineitem
q42_grouping_sets orders
q42_rollup_joined customer orders
q42_unpivot lineitem
q42_unpivot_frame lineitem
q43_asof_frame events orders
q44_pipe orders
q45_python_beside orders customer
"""
VIEW_BASES = {"open_orders": "orders", "priced_orders": "orders"}

# Statement types other than SELECT.
STATEMENTS = """
SELECT_JOIN q05_join q05_same_names q07_self_join q08_left_join q08_right_join q08_full_join q09_cross_join
SELECT_JOIN q10_exists q10_in q10_anti q32_coalesce q39_null_safe
SELECT_MULTIJOIN q06_three_way q06_five_way
SELECT_AGG q12_group_by q12_ten_aggregates q13_count_star q13_count_distinct q14_having q15_conditional_agg
SELECT_AGG q16_array_agg q18_rank q24_pivot
SELECT_AGG q42_rollup q42_cube q42_grouping_sets q44_pipe
SELECT_AGG_JOIN q42_rollup_joined
SELECT_JOIN q41_lateral_explode q41_lateral_select q41_lateral_stack q41_lateral_outer q45_python_beside
SELECT_MULTIJOIN q41_lateral_join q41_lateral_nested
SELECT_AGG_JOIN q11_scalar_subquery q27_asof q41_lateral
SELECT_JOIN q43_asof_frame
SELECT_WINDOW q17_row_number q18_rank_lag_frame q19_qualify q20_share q25_window_unnest
SELECT_UNION q21_union2 q21_union3 q21_union4 q22_mixed
SELECT_INTERSECT q22_intersect
SELECT_EXCEPT q22_except
SELECT_DISTINCT q23_distinct
SELECT_CTE q26_cte q26_cte_chain q26_cte_join q26_cte_twice q28_recursive q28_recursive_constant
SELECT_CTE q36_cte_join_agg_window
"""


def expected_columns() -> dict[str, dict[str, tuple[str, frozenset[str]]]]:
    """query -> output column -> (DIRECT or INDIRECT, sources as table.column)."""
    out: dict[str, dict] = {}
    for line in EXPECTED.strip("\n").splitlines():
        words = line.split()
        if not line.startswith(" "):
            name = words[0]
            out[name] = {}
        else:
            out[name][words[0]] = (words[1], frozenset(words[2:]))
    return out


def expected_fates(names) -> dict[str, tuple[int, int, int, int]]:
    """query -> numbers of output columns: all, traced, without a source, rejected."""
    traced, bare = expected_columns(), [line.split()[0] for line in SOURCELESS.strip().splitlines()]
    counts = {n: (len(traced.get(n, ())), bare.count(n), len(REJECTED.get(n, ()))) for n in names}
    return {n: (sum(c), *c) for n, c in counts.items()}


def expected_inputs() -> dict[str, set[str]]:
    return {w[0]: set(w[1:]) for w in map(str.split, INPUTS.strip().splitlines())}


def expected_statements(names) -> dict[str, str]:
    out = {n: "SELECT" for n in names}
    for kind, *queries in map(str.split, STATEMENTS.strip().splitlines()):
        out.update({q: kind for q in queries})
    return out
