"""Run a job: ``spark-submit run.py JOB ARGUMENTS``."""

import sys

from quillwork.jobs import main

if __name__ == "__main__":
    main(sys.argv[1:])
