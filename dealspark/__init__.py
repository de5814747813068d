"""dealspark: brokerage deal-ledger analytics as Spark DataFrame plans.

Entry points:
    dealspark.plans.pipeline.run(spark, inputs, cfg, out_base, run_date)   # the whole job, three outputs
    dealspark.plans.pipeline.Stages(spark, inputs, cfg)                    # every intermediate result
    dealspark.plans.registry.registry()                                    # every operator as a named query
    dealspark.sources.extracts.table_inputs / fixture_view_inputs            # where the ledger and roster come from
    dealspark.config.ReportConfig                                           # everything else
"""

__version__ = "3.0"  # stored stages of another version are not reused
