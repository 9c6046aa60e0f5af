from tramline.jobs import main

main()
