"""Entry script for `spark-submit`; ship the package with `--py-files` on a cluster."""

from hazeworks.jobs import main

if __name__ == "__main__":
    main()
