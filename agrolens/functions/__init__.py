from agrolens.functions.clean import *  # noqa: F401,F403
