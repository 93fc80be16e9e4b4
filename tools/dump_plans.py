"""Write the operator trees of headline operators' plans to docs/plans/.

usage: python tools/dump_plans.py [sf_dir]
Plans are taken after the stored cut points, i.e. what each stage runs.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(plan: str) -> str:
    """The operator tree of a formatted plan, without the details below it."""
    out = []
    for line in plan.splitlines():
        if line.startswith("(1)"):
            break
        out.append(line.rstrip())
    return "\n".join(out).strip() + "\n"


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from claimsmith import queries as Q
    from claimsmith.operators import codes
    from claimsmith.plans import episodes as EP
    from claimsmith.plans import sos as S
    from claimsmith.session import local_session
    spark = local_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    ctx = Q.Ctx(spark, sf)
    run = ctx.run
    plans = {
        "01_cohort_semi_join": codes.cohort_semi_join(ctx.windowed, codes.cohort_keys(ctx.windowed, Q.CFG)),
        "02_claim_flags": run.tagged,
        "03_hospital_rollup": EP.hospital_rollup(run.newborn_claims, Q.W.runout_end, Q.CFG),
        "04_stay_claims_range_join": EP.stay_claims(run.newborn_claims, run.hosp, Q.CFG),
        "05_dedup_claim_pick": EP.dedup_claim(EP.stay_claims(run.newborn_claims, run.hosp, Q.CFG)),
        "06_nicu_rollup": EP.nicu_rollup(run.ident, run.nicu_claims, run.hosp, Q.CFG),
        "07_sos_rollup": S.sos_rollup(ctx.sos_lines, Q.FX.xref_cbsa(spark, sf), Q.AMT, Q.CFG),
        "08_membership_periods": ctx.ps,
    }
    out_dir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for name, df in plans.items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as f:
            f.write(tree(buf.getvalue()))
        print(name, len(tree(buf.getvalue()).splitlines()), "lines")


if __name__ == "__main__":
    main()
