"""spark-submit launcher for the job (the package ships with --py-files).

    zip -r dealspark.zip dealspark
    spark-submit --py-files dealspark.zip run_job.py --ledger <table|path> --roster <table|path> \
        --begin 2019-01-01 --end 2020-12-31 --out <shared folder>
"""

from dealspark.__main__ import main

if __name__ == "__main__":
    main()
