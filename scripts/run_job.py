"""The job as a script that ``spark-submit`` accepts: spark-submit scripts/run_job.py INPUT [options] (see catlens.__main__)."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catlens.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main())
