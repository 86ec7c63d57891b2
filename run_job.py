"""Entry script for spark-submit; see stratalake/job.py."""

from stratalake.job import main

if __name__ == "__main__":
    main()
