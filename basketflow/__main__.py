from basketflow.plans.runner import main

main()
