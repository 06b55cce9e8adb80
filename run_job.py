"""Entry point for spark-submit; see README for the jobs."""

from basketflow.plans.jobs import main

if __name__ == "__main__":
    main()
