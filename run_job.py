"""spark-submit entry point: ``spark-submit run_job.py <job> --help``."""

from earshot.plans.jobs import main

if __name__ == "__main__":
    main()
