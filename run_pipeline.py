"""spark-submit entry for the daily run.

    spark-submit --py-files shelfwise.zip run_pipeline.py --root s3a://bucket/2024/12
"""

from shelfwise.plans.pipeline import main

if __name__ == "__main__":
    main()
